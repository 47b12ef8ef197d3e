"""Benchmark decontamination: q-gram lemma in overlapping diagonal bands, verified
by banded alignment."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import table
from kiln.llm.registry import query

Q = 10
STRIDE = 16
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def _char_tables() -> np.ndarray:
    """Per code point below 65536: the lower-case letter or digit, 32 for white
    space, 0 for signs, which are left out."""
    out = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        s = chr(c)
        if s.isspace():
            out[c] = 32
        elif s.isalnum():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_CHARS = _char_tables()


def normalise(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets in the text): letters and digits in lower case (and
    whatever lies beyond code point 65535), one space between words."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    cp = np.where(raw < 1 << 16, _CHARS[np.minimum(raw, (1 << 16) - 1)], raw)
    at = np.flatnonzero(cp)
    cp = cp[at]
    if len(cp):
        keep = np.ones(len(cp), bool)
        keep[1:] = (cp[1:] != 32) | (cp[:-1] != 32)
        keep[0] = cp[0] != 32
        if cp[-1] == 32:
            keep[len(cp) - 1 - np.argmax(cp[::-1] != 32) + 1 if (cp != 32).any() else 0:] = False
        cp, at = cp[keep], at[keep]
    return cp, at


def _grams(cp: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ``Q`` code points."""
    n = len(cp) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    wide = cp.astype(np.uint64)
    for j in range(Q):
        h = h * _PRIME + wide[j:n + j]
    return h ^ (h >> np.uint64(29))


def align(pattern: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best alignment of all of ``pattern`` with a part
    of ``text`` that starts between ``low`` and ``high`` (give or take ``most``), by
    dynamic programming in the band of these diagonals; None above ``most`` edits.
    Without an edit no table is needed."""
    same = text[max(low, 0):high + len(pattern)]
    at = same.tobytes().find(pattern.tobytes())
    if at >= 0 and at % pattern.itemsize == 0:
        start = max(low, 0) + at // pattern.itemsize
        return 0, start, start + len(pattern)

    def table_(p, t, first, width, free):
        d = np.zeros(width, np.int64) if free else np.full(width, 1 << 30)
        d[0 if free else width // 2] = 0
        cols = np.arange(width)
        for i, c in enumerate(p):
            idx = first + i + cols
            chars = np.where((idx >= 0) & (idx < len(t)), t[np.clip(idx, 0, max(len(t) - 1, 0))], 0)
            step = d + (chars != c)
            step[:-1] = np.minimum(step[:-1], d[1:] + 1)
            d = np.minimum.accumulate(step - cols) + cols
        return d
    first, width = low - most, high - low + 1 + 2 * most
    last = table_(pattern, text, first, width, True)
    j = int(np.argmin(last))
    if last[j] > most:
        return None
    end = min(first + len(pattern) + j, len(text))
    back = table_(pattern[::-1], text[::-1], len(text) - end - most, 2 * most + 1, False)
    best = int(np.argmin(back))
    start = end - (len(pattern) + best - most)
    return int(last[j]), max(0, start), end


class Index:
    """q-grams of the segments of benchmark items. An item is cut into equal
    segments of ``segment`` characters or more; besides these, every ``STRIDE``
    characters one of exactly ``segment`` begins, the last one flush with the end, so
    that part of an item is found wherever it begins. One of all is enough to report."""

    def __init__(self, items: list[tuple], segment: int, error: float):
        self.segments, grams, owners, offsets = [], [], [], []
        self.item, self.equal = [], []
        for item, (item_id, text) in enumerate(items):
            cp, _ = normalise(text)
            n = max(1, len(cp) // segment)
            cuts = [(s * len(cp) // n, (s + 1) * len(cp) // n) for s in range(n)]
            last = len(cp) - segment
            cuts += [(a, a + segment) for a in [*range(0, last, STRIDE), last] if last > 0 and (a, a + segment) not in cuts]
            for s, (a, z) in enumerate(cuts):
                part = cp[a:z]
                g = _grams(part)
                if len(g):
                    budget = min(int(error * len(part)), (len(g) - 1) // Q)
                    owners.append(np.full(len(g), len(self.segments)))
                    grams.append(g)
                    offsets.append(np.arange(len(g)))
                    self.segments.append((item_id, s, part, budget))
                    self.item.append(item)
                    self.equal.append(s < n)
        flat = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.owner = (np.concatenate(owners) if owners else np.empty(0, np.int64))[order]
        self.offset = (np.concatenate(offsets) if offsets else np.empty(0, np.int64))[order]
        self.gram, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self.gram >> np.uint64(64 - _BITS)] = True
        self.width = np.array([s[3] + 1 for s in self.segments], np.int64)
        self.need = np.array([max(1, len(s[2]) - Q + 1 - Q * s[3]) for s in self.segments], np.int64)

    def bands(self, cp: np.ndarray):
        """(segment, first diagonal, last diagonal) of the regions of a text that
        share enough q-grams with a segment: by the lemma, an alignment with at
        most k edits keeps m - q + 1 - q k of its m - q + 1 q-grams, on diagonals
        at most k apart, which lie in one of two overlapping bands of 2 (k + 1)."""
        h = _grams(cp)
        if not len(h) or not len(self.gram):
            return
        at = np.flatnonzero(self.maybe[h >> np.uint64(64 - _BITS)])
        g = np.searchsorted(self.gram, h[at])
        same = self.gram[np.minimum(g, len(self.gram) - 1)] == h[at]
        at, g = at[same], g[same]
        if not len(at):
            return
        n = self.count[g]
        post = np.repeat(self.first[g] - np.cumsum(n) + n, n) + np.arange(n.sum())
        seg = self.owner[post]
        diagonal = np.repeat(at, n) - self.offset[post]
        span = np.int64(1) << 40
        key, hits = np.unique(seg * span + (diagonal // self.width[seg] + (span >> 1)), return_counts=True)
        both = hits.copy()
        follows = np.flatnonzero(key[1:] == key[:-1] + 1)
        both[follows] += hits[follows + 1]
        found = np.flatnonzero(both >= self.need[key // span])
        runs = np.split(found, np.flatnonzero(np.diff(key[found]) != 1) + 1) if len(found) else []
        for run in runs:
            s = int(key[run[0]] // span)
            w = int(self.width[s])
            yield s, int(key[run[0]] % span - (span >> 1)) * w, int(key[run[-1]] % span - (span >> 1) + 2) * w - 1

    def _hits(self, text: str) -> list[tuple]:
        """(segment, start, end, edits) of segments that occur in a text within their
        edit budget."""
        cp, at = normalise(text)
        out = []
        for s, low, high in self.bands(cp):
            hit = align(self.segments[s][2], cp, low, high, self.segments[s][3])
            if hit:
                out.append((s, int(at[hit[1]]), int(at[hit[2] - 1]) + 1, hit[0]))
        return out

    def _rows(self, hits: list[tuple]) -> list[dict]:
        out = [{"item_id": self.segments[s][0], "segment": self.segments[s][1], "start": start, "end": end, "edits": edits}
               for s, start, end, edits in hits]
        return sorted(out, key=lambda x: (x["start"], x["end"], str(x["item_id"]), x["segment"]))

    def leaks(self, text: str) -> list[dict]:
        """Segments that occur in a text within their edit budget."""
        return self._rows(self._hits(text))

    def new_leaks(self, text: str) -> list[dict]:
        """The leaks: all equal segments, and overlapping ones that do not lie within
        what the segments before them in the same item have found."""
        hits, covered = [], defaultdict(list)
        for hit in sorted(self._hits(text), key=lambda x: x[:3]):
            reach = hit[1]
            for a, z in sorted(covered[self.item[hit[0]]]):
                if a <= reach:
                    reach = max(reach, z)
            if reach < hit[2] or self.equal[hit[0]]:
                hits.append(hit)
                covered[self.item[hit[0]]].append(hit[1:3])
        return self._rows(hits)


def mark_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
               segment: int = 64, error: float = 0.07, block_chars: int = 1_000_000, name: str = "leaks") -> DataFrame:
    """``docs`` with an array ``name`` of (item_id, segment, start, end, edits):
    segments of benchmark items found in the whole text, with offsets in code
    points, end exclusive. An overlapping segment is listed only where it adds to
    what the others of its item have found. A verbatim part of an item of
    ``segment`` + ``STRIDE`` - 1 characters holds a segment wherever it begins.

    Texts are compared as lower-case letters and digits with one space between
    words. A segment may differ by ``error`` x its length in edits (but only as
    many as leave it a q-gram). Null and empty texts have no leak; items that
    are null or shorter than ``Q`` are never found; repeated items are reported
    once for each different text, repeated rows alike.

    Items go to the tasks in blocks of about ``block_chars`` characters, as many
    as the benchmark fills; each block is held against all documents.
    """
    wanted = items.where(F.col(item_text).isNotNull()).select(F.col(item_col).alias("i"), F.col(item_text).alias("t")).distinct()
    total = wanted.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))
    id_type = items.schema[item_col].dataType.simpleString()
    names = [c for c in docs.columns if c != name]
    out = docs.select(*names).withColumn(name, F.array().cast(
        f"array<struct<item_id:{id_type},segment:int,start:int,end:int,edits:int>>"))
    for block in range(blocks):
        mine = [(r.i, r.t) for r in wanted.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block).orderBy("i", "t").collect()]
        schema = out.schema

        def found(batches, mine=mine, schema=schema):
            index = Index(mine, segment, error)
            for b in batches:
                old = b.column(name).to_pylist()
                got = [o + index.new_leaks(t.as_py() or "") for o, t in zip(old, b.column(text_col))]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, b.schema.field(name).type)], names=[*names, name])
        out = out.mapInArrow(found, schema)
    return out


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a leak, all columns unchanged."""
    return mark_leaks(docs, items, name="_kiln_leaks", **options).where(F.size("_kiln_leaks") == 0).drop("_kiln_leaks")


@query("op6_decontamination")
def op6_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_leaks(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
