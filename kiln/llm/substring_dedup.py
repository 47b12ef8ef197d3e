"""Substring deduplication: content-defined chunks (gear rolling hash), compared by
digests of stretches of neighbouring chunks. A sample of stretches, taken by their
content, first tells which documents share a passage at all."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import bitmap_array, frozen, in_bitmap, key_bitmap, marked, table, text_of
from kiln.llm.registry import query

WINDOW = 16
_RNG = np.random.default_rng(20240229)
_GEAR = _RNG.integers(0, 1 << 16, 1 << 16, dtype=np.uint32)
_VALUE = _RNG.integers(0, 1 << 63, 1 << 16, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _cut(text: str, mean: int):
    """(bounds, words before each bound, whether a bound lies within a word, running
    hash before each code point) of a text."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(cp)
    if not n:
        return np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, bool), np.zeros(1, np.uint64)
    low = cp & 0xFFFF
    gear = _GEAR[low]
    h = gear.copy()
    for k in range(1, min(WINDOW, n)):
        h[k:] += gear[:n - k] << np.uint32(k)
    low16 = h & 0xFFFF
    ends = np.flatnonzero(low16 < (1 << 16) // mean) + 1
    bounds = np.unique(np.concatenate([[0], ends, [n]]))
    bounds = np.union1d(bounds, _more_bounds(low16, bounds, mean))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_VALUE[low] + cp) * _powers(_BASE, n), dtype=np.uint64)])
    space = (cp == 32) | ((cp >= 9) & (cp <= 13))
    starts = ~space
    starts[1:] &= space[:-1]
    words = np.concatenate([[0], np.cumsum(starts)])
    within = np.concatenate([~space & ~starts, [False]])
    return bounds, words[bounds], within[bounds], total


def _more_bounds(low16: np.ndarray, bounds: np.ndarray, mean: int) -> np.ndarray:
    """Bounds inside chunks longer than 4 x ``mean``, as of a phrase said again and
    again: each where the hash is least (the first such place) between ``mean`` and
    4 x ``mean`` after the one before, so that they come at one place of the phrase."""
    most, out = 4 * mean, []
    for k in np.flatnonzero(np.diff(bounds) > most).tolist():
        at, stop = int(bounds[k]), int(bounds[k + 1])
        while stop - at > mean + 1:
            at += mean + int(low16[at + mean:min(at + most, stop)].argmin()) + 1
            out.append(at)
    return np.array(out, np.int64)


def _digest(total: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Hashes of the code points from each of ``a`` to each of ``z``, wherever they stand."""
    d = (total[z] - total[a]) * _powers(_BASE_INVERSE, len(total))[a]
    return ((d ^ (d >> np.uint64(31))) * np.uint64(_BASE) + (z - a).astype(np.uint64)).view(np.int64)


def chunks(text: str, mean: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, digests, words before each bound) of a text's chunks, in code
    points. A chunk ends where the gear hash of the last ``WINDOW`` code points
    is below a threshold, on average after ``mean`` of them, so that bounds move
    with the content. There is no least or greatest size."""
    bounds, words, _, total = _cut(text, mean)
    return bounds, _digest(total, bounds[:-1], bounds[1:]), words


def stretches(text: str, mean: int, min_words: int) -> tuple[np.ndarray, ...]:
    """(digests, starts, ends, words before the start, words before the end, start
    and end within a word) of the shortest stretches of neighbouring chunks with
    ``min_words`` words, the first of which may be cut: one from each bound on, one
    up to each bound. Whatever run of whole chunks with so many words two texts
    share, such stretches cover it, and both texts have them."""
    bounds, words, within, total = _cut(text, mean)
    before = words - within
    m = len(bounds)
    on = np.searchsorted(words, before + min_words, "left")
    back = np.searchsorted(before, words - min_words, "right") - 1
    at = np.arange(m)
    pair = np.unique(np.concatenate([(at * m + on)[on < m], (back * m + at)[back >= 0]]))
    i, j = pair // m, pair % m
    return _digest(total, bounds[i], bounds[j]), bounds[i], bounds[j], words[i], words[j], within[i], within[j]


def selected(text: str, mean: int, min_words: int, reach: int) -> np.ndarray:
    """Digests of the stretches from a bound on that are the least of all beginning
    within ``reach`` words, for some such window. Two texts that share a run long
    enough for one window and its stretches select one stretch of it both."""
    bounds, words, within, total = _cut(text, mean)
    on = np.searchsorted(words, words - within + min_words, "left")
    at = np.flatnonzero(on < len(bounds))
    if not len(at):
        return np.empty(0, np.int64)
    least, w = _digest(total, bounds[at], bounds[on[at]]), words[at]
    stop = np.searchsorted(w, w + reach, "left")
    out, step, n = least.copy(), 1, len(at)
    power = np.floor(np.log2(stop - np.arange(n))).astype(int)
    for k in range(int(power.max()) + 1):  # ``least`` covers 2^k stretches from each on
        own = np.flatnonzero(power == k)
        out[own] = np.minimum(least[own], least[stop[own] - step])
        least = np.minimum(least, least[np.minimum(np.arange(n) + step, n - 1)])
        step *= 2
    return np.unique(out)


_NO_ID = "\U0010FFFF"


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_doc, _tk, _id, _text): rows that share an id are one document, rows without
    an id are documents by a hash of their text. Keys are whole numbers for whole
    numbers as ids, else strings."""
    text = text_of(text_col)
    tk = F.xxhash64(text)
    if docs.schema[id_col].dataType.typeName() in ("long", "integer", "short", "byte"):
        key = F.coalesce(F.col(id_col).cast("long"), tk)
    else:
        key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit(_NO_ID), tk.cast("string")))
    return docs.select(key.alias("_doc"), tk.alias("_tk"), F.col(id_col).alias("_id"), text.alias("_text"))


def sharing_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mean: int = 20, min_words: int = 25,
                      reach: int = 16) -> DataFrame:
    """Keys (_doc) of the documents that share a selected stretch with another one:
    all that share a passage of over 50 words, and some with shorter ones.

    Some 0.015 digests a character leave the first pass. They are stored, counted by
    digest with partial aggregation, and those of several documents give these.
    """
    rows = _rows(docs, id_col, text_col).select("_doc", "_text")

    def digests(batches):
        for b in batches:
            for k, t in zip(b.column("_doc"), b.column("_text")):
                d = selected(t.as_py(), mean, min_words, reach)
                if len(d):
                    yield pa.RecordBatch.from_arrays([pa.array(d), pa.repeat(k, len(d))], names=["_d", "_doc"])
    seen = frozen(rows.mapInArrow(digests, f"_d long, _doc {rows.schema['_doc'].dataType.simpleString()}"))
    several = seen.groupBy("_d").agg(F.min("_doc").alias("_a"), F.max("_doc").alias("_b")).where("_a < _b").select("_d")
    return seen.join(several, "_d").select("_doc").distinct()


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mean: int = 20, min_words: int = 25,
                   max_bits: int = 1 << 27) -> DataFrame:
    """Passages that occur in several documents: ``id_col``, start, end (code
    points, end exclusive), n_words, first_id (smallest id that has a stretch of it;
    the document's own where it is the first; of a document without an id a hash of
    its text, or null if ids are text), removed (whether an earlier document has it).

    Whole texts are cut into chunks; a passage is compared by the digests of its
    stretches of neighbouring chunks with ``min_words`` words. The documents that
    share a passage of over 50 words (``sharing_documents``) are compared as a whole:
    a stretch is repeated if documents with different keys hold all of it, and it
    belongs to the one with the smallest key. What stretches of earlier documents
    cover is removed, the rest of what repeated stretches cover is not: spans do not
    overlap, and whoever deletes the removed ones keeps one holder of all they say.
    A span that is not removed may be shorter than ``min_words`` where it goes on
    from a removed one.

    Spans lose the part of a passage that lies before its first and after its last
    chunk bound, ``mean`` characters on average on each side; ``min_words`` is set
    so that passages of over 50 words are found. Ids that are neither whole numbers
    nor text are ordered as text.

    Null and empty texts have no span. Rows that share an id are one document,
    rows without an id are documents by their text; repeated rows are reported
    once. An empty table gives an empty result; other columns are ignored.

    Only the texts of sharing documents move, once; others are told apart by a bitmap
    of ``max_bits`` bits at most, and by a join. Their (digest, document) pairs are
    counted with partial aggregation; then the stretches are looked up in a bitmap
    of the repeated digests and only those that may be repeated are shuffled: to
    the digests by one join, then to their documents. The joins decide.
    """
    every = _rows(docs, id_col, text_col)
    sharing = frozen(sharing_documents(docs, id_col, text_col, mean, min_words))
    bits = max(1 << 20, min(max_bits, 1 << (8 * sharing.count() + 1).bit_length()))
    h = F.xxhash64("_doc")
    maybe = marked(every, key_bitmap(sharing, h, bits), h, bits, "_maybe").where("_maybe").drop("_maybe")
    rows = frozen(maybe.join(sharing.hint("shuffle_hash"), "_doc", "left_semi"))
    key = rows.schema["_doc"].dataType.simpleString()

    def digests(batches):
        for b in batches:
            for k, t in zip(b.column("_doc"), b.column("_text")):
                d = np.unique(stretches(t.as_py(), mean, min_words)[0])
                if len(d):
                    yield pa.RecordBatch.from_arrays([pa.array(d), pa.repeat(k, len(d))], names=["_d", "_doc"])
    seen = rows.select("_doc", "_text").mapInArrow(digests, f"_d long, _doc {key}")
    repeated = frozen(seen.groupBy("_d").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last"))
                          .where("_first < _last").select("_d", "_first"))
    bits = max(1 << 20, min(max_bits, 1 << (8 * repeated.count() + 1).bit_length()))
    bitmap = rows.sparkSession.sparkContext.broadcast(bitmap_array(key_bitmap(repeated, F.col("_d"), bits), bits))
    id_type = docs.schema[id_col].dataType
    names = ["_start", "_end", "_w0", "_w1", "_in0", "_in1"]
    whole = f"_d long, _doc {key}, _tk long, _id {id_type.simpleString()}, _start int, _end int, _w0 int, _w1 int, _in0 int, _in1 int"

    def located(batches):
        bit = bitmap.value
        for b in batches:
            for k, tk, i, t in zip(*(b.column(c) for c in ("_doc", "_tk", "_id", "_text"))):
                d, *where = stretches(t.as_py(), mean, min_words)
                at = np.flatnonzero(in_bitmap(bit, d))
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(d[at]), *(pa.repeat(v, len(at)) for v in (k, tk, i)), *(pa.array(x[at].astype(np.int32)) for x in where)],
                        names=["_d", "_doc", "_tk", "_id", *names])
    first_id = F.coalesce("_first", "_doc")
    if key == "string":
        first_id = F.when(~first_id.startswith(_NO_ID), first_id).cast(id_type)
    earlier = F.col("_first") < F.col("_doc")
    hit = (rows.mapInArrow(located, whole).join(repeated, "_d")
               .select("_doc", "_tk", "_id", *names, F.when(earlier, F.col("_first")).alias("_earlier"))
               .repartition("_doc", "_tk"))
    # what is open at each bound: a stretch adds one where it starts and takes it away where it ends
    gone = F.col("_earlier").isNotNull().cast("int")
    ends = F.array(F.struct(F.col("_start").alias("at"), F.col("_w0").alias("w"), F.col("_in0").alias("within"),
                            F.lit(1).alias("open"), gone.alias("gone"), F.col("_earlier").alias("first")),
                   F.struct(F.col("_end").alias("at"), F.col("_w1").alias("w"), F.col("_in1").alias("within"),
                            F.lit(-1).alias("open"), (-gone).alias("gone"), F.lit(None).cast(key).alias("first")))
    points = (hit.select("_doc", "_tk", "_id", F.explode(ends).alias("e")).select("_doc", "_tk", "_id", "e.*")
                 .groupBy("_doc", "_tk", "at").agg(F.min("_id").alias("_id"), F.first("w").alias("w"), F.first("within").alias("within"),
                                                   F.sum("open").alias("open"), F.sum("gone").alias("gone"), F.min("first").alias("first")))
    order = Window.partitionBy("_doc", "_tk").orderBy("at")
    state = F.when(F.sum("gone").over(order) > 0, 2).when(F.sum("open").over(order) > 0, 1).otherwise(0)
    stated = points.withColumn("_state", state)
    pieces = (stated.withColumn("_new", (F.col("_state") != F.lag("_state", 1, 0).over(order)).cast("int"))
                    .withColumn("_piece", F.sum("_new").over(order))
                    .groupBy("_doc", "_tk", "_piece")
                    .agg(F.min("_id").alias("_id"), F.first("_state").alias("_state"), F.min("at").alias("_at"),
                         F.min_by("w", "at").alias("_w"), F.min_by("within", "at").alias("_within"), F.min("first").alias("_first")))
    after = Window.partitionBy("_doc", "_tk").orderBy("_piece")
    spans = pieces.withColumn("_end", F.lead("_at").over(after)).withColumn("_words", F.lead("_w").over(after)).where("_state > 0")
    return spans.select(F.col("_id").alias(id_col), F.col("_at").alias("start"), F.col("_end").alias("end"),
                        (F.col("_words") - F.col("_w") + F.col("_within")).cast("long").alias("n_words"),
                        first_id.alias("first_id"), (F.col("_state") == 2).alias("removed"))


@query("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    return repeated_spans(table(spark, sf_dir, "documents"))
