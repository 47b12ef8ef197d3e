"""Periodic runs of words: a dictionary of basic factors names the word runs of every
power-of-two length; progressions of a factor's occurrences propose periods."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import table, text_of
from kiln.llm.registry import query


class Factors:
    """Names of the word runs of length 1, 2, 4, ... of several texts laid end to end.

    Level k holds, in order of position, the positions whose run of 2^k words
    occurs again in the same text, and a name for it that only its copies in that
    text share. A run that does not occur again needs no name, so that levels
    shrink fast in ordinary texts.
    """

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        """``words``: number of each word; ``doc``: number of its text, ascending."""
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        at = np.arange(len(words))
        key = doc.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
        while len(at):
            at, name = _again(at, key)
            if not len(at):
                break
            self.levels.append((at, name))
            step = 1 << (len(self.levels) - 1)
            right = _find(at, at + step)
            both = (right >= 0) & (doc[at] == doc[np.minimum(at + step, len(doc) - 1)])
            at, key = at[both], name[both] * (len(name) + 1) + name[right[both]]

    def equal(self, k: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the runs of 2^k words at i and j (i < j) are the same."""
        at, name = self.levels[k]
        a, b = _find(at, i), _find(at, j)
        return (a >= 0) & (b >= 0) & (name[a] == name[b])

    def common(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """Length of the longest common run that starts at i and at j, or that ends
        before them with ``back``."""
        n = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            step = 1 << k
            same = self.equal(k, i - n - step, j - n - step) if back else self.equal(k, i + n, j + n)
            n += step * same
        return n


def _again(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions whose key is not unique, and a number for each key."""
    _, name, n = np.unique(key, return_inverse=True, return_counts=True)
    keep = n[name] > 1
    return at[keep], name[keep]


def _find(at: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Index of each wanted position in the sorted ``at``, -1 where it is not there."""
    i = np.minimum(np.searchsorted(at, want), len(at) - 1)
    return np.where(at[i] == want, i, -1)


def _proposals(at: np.ndarray, name: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, q): positions and periods m <= q < 2m proposed by the runs of m words.

    Occurrences of one run that follow each other by m/2 or less are an arithmetic
    progression with its period as difference. Two neighbouring progressions (the
    next three, since further ones are 2m away) with the same difference d, the
    first ending at t and the second beginning at h, propose h - t, h - t + d, ...
    as far as their members reach: every square of period q repeats its first m
    words q later, and all members with one distance lie in one run.
    """
    order = np.lexsort((at, name))
    p, c = at[order], name[order]
    gap = np.diff(p)
    linked = (c[1:] == c[:-1]) & (2 * gap <= m)
    head = np.flatnonzero(np.concatenate([[True], ~linked]))
    size = np.diff(np.concatenate([head, [len(p)]]))
    first, last, names = p[head], p[head + size - 1], c[head]
    diff = np.where(size > 1, gap[np.minimum(head, len(gap) - 1)] if len(gap) else 0, 0)
    out_i, out_q = [], []
    for ahead in (1, 2, 3):
        a = np.flatnonzero(names[:-ahead] == names[ahead:]) if len(names) > ahead else np.empty(0, np.int64)
        near = first[a + ahead] - last[a] if len(a) else a
        a, near = a[near < 2 * m], near[near < 2 * m]
        b = a + ahead
        d = np.maximum(diff[a], diff[b])
        more = size[a] - 1 + size[b] - 1
        reach = np.where(d > 0, np.minimum(more, (2 * m - 1 - near) // np.maximum(d, 1)), 0)
        skip = np.where(near < m, np.where(d > 0, -(-(m - near) // np.maximum(d, 1)), 1), 0)
        n = np.maximum(reach - skip + 1, 0)
        which = np.repeat(np.arange(len(a)), n)
        step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + skip[which]
        left = np.minimum(step, (size[a] - 1)[which])
        out_i.append(last[a][which] - left * d[which])
        out_q.append(near[which] + step * d[which])
    i, q = np.concatenate(out_i), np.concatenate(out_q)
    order = np.lexsort((i, q))
    i, q = i[order], q[order]
    # neighbours with one period lie in one run: the first stands for them
    new = np.ones(len(i), bool)
    new[1:] = (q[1:] != q[:-1]) | (i[1:] - i[:-1] > m)
    return i[new], q[new]


def runs_of(words: np.ndarray, doc: np.ndarray, least: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all maximal periodic runs with ``least`` words and
    ``repeats`` (2 or more) periods at least, by start and period. Positions count
    through all texts; no run passes from one text into the next."""
    factors = Factors(words, doc)
    starts, ends, periods = [], [], []
    for k, (at, name) in enumerate(factors.levels):
        i, q = _proposals(at, name, 1 << k)
        if not len(i):
            continue
        start = i - factors.common(i, i + q, back=True)
        end = i + q + factors.common(i, i + q)
        good = end - start >= np.maximum(least, repeats * q)
        starts.append(start[good])
        ends.append(end[good])
        periods.append(q[good])
    if not starts:
        return (np.empty(0, np.int64),) * 3
    start, end, q = (np.concatenate(x) for x in (starts, ends, periods))
    # of one stretch the smallest period counts; others found are its multiples
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


_RESULT = ("n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
           "starts array<long>, lengths array<long>, periods array<long>, collapsed string")


def _chunks(rows, most: int) -> Iterator[list]:
    """Groups of neighbouring texts with about ``most`` words together, longer ones by themselves."""
    group, n = [], 0
    for row in rows:
        group.append(row)
        n += len(row[1])
        if n >= most:
            yield group
            group, n = [], 0
    if group:
        yield group


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12, repeats: int = 2,
                  rewrite: Callable[[object, list], list] | None = None, chunk_words: int = 200_000) -> DataFrame:
    """All maximal periodic runs of words of each whole text. Returns ``id_col`` and
    n_words, n_runs, of the longest run (ties: smallest start, then period; null
    without one) start, length, period and exponent_milli, the arrays starts,
    lengths and periods of every run by start and period, and collapsed: the words
    that no run holds after its first period, joined by one space.

    Words are what lies between the six white-space characters. A run has
    ``least`` words and ``repeats`` periods at least, its period is its smallest,
    and no neighbouring word goes on with it. ``rewrite(id, words)`` may replace a
    text's words (bytes) first.

    A row gives a row: null and empty texts have no words and no run, repeated rows
    and rows without an id are answered each by itself, other columns are ignored,
    an empty table gives an empty result. Texts are worked out where they are read,
    some ``chunk_words`` words at a time (one longer text by itself) and n log n
    names at most; nothing is shuffled.
    """
    def rows(batch):
        for i, (key, text) in enumerate(zip(batch.column("_id"), batch.column("_text"))):
            words = text.as_py().encode("utf-8", "surrogatepass").split()
            yield i, rewrite(key.as_py(), words) if rewrite else words

    def answers(batches):
        for b in batches:
            for group in _chunks(rows(b), chunk_words):
                yield _answer(b.column("_id").slice(group[0][0], len(group)), [w for _, w in group], least, repeats)
    plain = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    done = plain.mapInArrow(answers, f"_id {plain.schema['_id'].dataType.simpleString()}, {_RESULT}")
    return done.select(F.col("_id").alias(id_col), *[c for c in done.columns if c != "_id"])


def _answer(ids, texts: list, least: int, repeats: int) -> pa.RecordBatch:
    sizes = np.array([len(w) for w in texts])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    number = {w: i for i, w in enumerate(dict.fromkeys(w for words in texts for w in words))}
    words = np.fromiter((number[w] for t in texts for w in t), np.int64, int(begin[-1]))
    start, end, period = runs_of(words, np.repeat(np.arange(len(texts)), sizes), least, repeats)
    owner = np.searchsorted(begin, start, "right") - 1
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = {name: [] for name in ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "starts", "lengths", "periods", "collapsed")}
    for t, own in enumerate(texts):
        s, e, q = (x[cut[t]:cut[t + 1]] for x in (start, end, period))
        s, e = s - begin[t], e - begin[t]
        n, kept = e - s, own
        if len(s):
            # words after the first period of a run: one open interval more at each start, one less at its end
            edge = np.zeros(len(own) + 1, np.int64)
            np.add.at(edge, s + q, 1)
            np.add.at(edge, e, -1)
            kept = [w for w, open_ in zip(own, np.cumsum(edge[:-1]).tolist()) if not open_]
        best = int(np.lexsort((q, s, -n))[0]) if len(s) else None
        one = (None,) * 4 if best is None else (int(s[best]), int(n[best]), int(q[best]), int(1000 * n[best] // q[best]))
        for name, v in zip(out, (len(own), len(s), *one, s, n, q, b" ".join(kept).decode("utf-8", "surrogatepass"))):
            out[name].append(v)
    types = [pa.int64()] * 6 + [pa.list_(pa.int64())] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([ids, *(pa.array(v, t) for v, t in zip(out.values(), types))], names=["_id", *out])


def planted(doc_id, words: list) -> list:
    """The words of a text with the contract's repetition: for one id in ten, by
    crc32, all words from a on repeat p of them. A text without an id stays."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


_CRC = """list_reduce([4294967295::BIGINT] || list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda i: ascii(CAST(doc_id AS VARCHAR)[i + 1])::BIGINT),
  lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)))"""


@query("op13_periodic_runs", rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, xor({_CRC}, 4294967295) AS h FROM documents),
m AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM m),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
x AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(list_transform(range(n), lambda i: CASE WHEN i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END)) AS word FROM p),
e AS (SELECT l.doc_id, l.i, r.i - l.i AS q FROM x l JOIN x r ON l.doc_id = r.doc_id AND l.word = r.word AND l.i < r.i),
z AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
r AS (SELECT doc_id, q, min(i) AS s, max(i) + q + 1 AS e FROM z GROUP BY doc_id, q, island HAVING count(*) >= q AND count(*) + q >= 12),
u AS (SELECT doc_id, s AS start, e - s AS length, min(q) AS period FROM r GROUP BY doc_id, s, e),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS best FROM u),
t AS (SELECT doc_id, count(*) AS n_runs, max(start) FILTER (WHERE best = 1) AS start, max(length) FILTER (WHERE best = 1) AS length,
             max(period) FILTER (WHERE best = 1) AS period, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS runs
      FROM b GROUP BY doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM u),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) FILTER (WHERE g.i IS NULL) AS kept
      FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.i = g.i GROUP BY x.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start, length, period, (1000 * length // period)::BIGINT AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN t ON d.doc_id = t.doc_id LEFT JOIN k ON d.doc_id = k.doc_id
""")
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted)
    lines = F.transform(F.arrays_zip("starts", "lengths", "periods"),
                        lambda r: F.concat(F.concat_ws(",", r["starts"], r["lengths"], r["periods"]), F.lit("\n")))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
