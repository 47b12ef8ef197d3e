"""N-gram Jaccard join: blocked sparse product of the document by n-gram matrix."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import frozen, keep_rows, key_bitmap, marked, table, text_of
from kiln.llm.graph import components
from kiln.llm.registry import query

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.int64(-0x61C8864680B583EB)
_STRIPES = 64
_FEW = 12


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``k`` words (A-Z in lower
    case); of all words together if they are fewer; none without a word."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(k, n)
    h = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        h = (h ^ (h >> np.uint64(29))) * _MIX + w[j:n - size + 1 + j]
    h ^= h >> np.uint64(32)
    return np.unique(h * _MIX)


def class_of(s: np.ndarray) -> int:
    """Number of a set of shingles: documents with equal sets are one class."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def parity(s: np.ndarray) -> bytes:
    """Parities of the numbers of shingles in a power of two of bins, as many bins as
    shingles or more, so that unrelated sets of a size differ in far more bins than
    a link allows. Two sets differ by at least as many shingles as bins."""
    bins = max(64, 1 << max(len(s) - 1, 1).bit_length())
    at = np.bincount(((s >> np.uint64(20)) & np.uint64(bins - 1)).astype(np.int64), minlength=bins) & 1
    return np.packbits(at.astype(np.uint8)).tobytes()


def may_link(sigs: list[bytes], n: np.ndarray, percent: int) -> np.ndarray:
    """Boolean matrix of the pairs whose sizes and parities allow a link. Of a pair,
    the parities of the larger set are folded to as many bins as the smaller has."""
    lengths, n = np.array([len(x) for x in sigs]), n.astype(np.int64)
    differ = np.zeros((len(n), len(n)), np.int32)
    for size in np.unique(lengths):
        own = np.flatnonzero(lengths == size)
        near = np.flatnonzero((lengths >= size) & (percent * n <= 100 * n[own].max()))
        words = np.stack([np.bitwise_xor.reduce(np.frombuffer(sigs[i], np.uint64).reshape(-1, size // 8), axis=0) for i in near])
        block = np.zeros((len(own), len(near)), np.int32)
        for a, b in zip(words[np.searchsorted(near, own)].T, words.T):
            block += np.bitwise_count(a[:, None] ^ b[None, :])
        differ[np.ix_(own, near)] = block
        differ[np.ix_(near, own)] = block.T
    both = n[:, None] + n[None, :]
    ok = differ <= both - 2 * -(-percent * both // (100 + percent))
    ok &= 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
    np.fill_diagonal(ok, False)
    return ok


def few_labels(c: list, n: list, sigs: list[bytes], percent: int) -> list:
    """Labels of a short list, as ``smallest_reachable`` of ``may_link`` gives them."""
    whole = [int.from_bytes(sig, "little") for sig in sigs]

    def folded(i, bits):
        v, size = whole[i], 8 * len(sigs[i])
        while size > bits:
            size //= 2
            v = (v & ((1 << size) - 1)) ^ (v >> size)
        return v
    label = list(c)
    for i in range(1, len(c)):
        for j in range(i):
            if label[i] != label[j] and 100 * min(n[i], n[j]) >= percent * max(n[i], n[j]):
                both, bits = n[i] + n[j], 8 * min(len(sigs[i]), len(sigs[j]))
                if (folded(i, bits) ^ folded(j, bits)).bit_count() <= both - 2 * -(-percent * both // (100 + percent)):
                    old, new = max(label[i], label[j]), min(label[i], label[j])
                    label = [new if x == old else x for x in label]
    return label


def prefix(s: np.ndarray, frequency: np.ndarray, percent: int) -> np.ndarray:
    """The shingles that come first, rare ones before frequent ones, as many as
    two sets must share one of if their Jaccard similarity reaches ``percent``."""
    n = len(s)
    p = n - -(-percent * n // 100) + 1
    rare = frequency[(s & np.uint64(len(frequency) - 1)).astype(np.int64)]
    return s[np.lexsort((s, rare))[:p]]


def overlaps(sets: list[np.ndarray], dense_from: int = 48, columns: int = 4096, flush: int = 1 << 22) -> np.ndarray:
    """Matrix of the numbers of shared shingles, the product of the incidence
    matrix with its transpose: columns with many documents by blocks of a dense
    product, the others by adding up their pairs."""
    m = len(sets)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    _, col, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((m, m), np.float32)
    often = df > dense_from
    number = np.cumsum(often) - 1
    pick = often[col]
    r, c = rows[pick], number[col[pick]]
    order = np.argsort(c, kind="stable")
    r, c = r[order], c[order]
    for start in range(0, int(often.sum()), columns):
        a, b = np.searchsorted(c, (start, start + columns))
        x = np.zeros((m, columns), np.float32)
        x[r[a:b], c[a:b] - start] = 1
        out += x @ x.T
    pick = (df[col] > 1) & ~often[col]
    r, c, d = rows[pick], col[pick], df[col[pick]]
    order = np.lexsort((r, c, d))
    r, d = r[order], d[order]
    codes, held = [], 0

    def add():
        nonlocal held
        if codes:
            upper = np.bincount(np.concatenate(codes), minlength=m * m).reshape(m, m).astype(np.float32)
            np.add(out, upper, out=out)
            np.add(out, upper.T, out=out)
        codes.clear()
        held = 0
    for size in np.unique(d):
        a, b = np.searchsorted(d, (size, size + 1))
        own = r[a:b].reshape(-1, size)
        for s in range(1, size):
            codes.append((own[:, :-s] * m + own[:, s:]).ravel())
            held += len(codes[-1])
            if held > flush:
                add()
    add()
    return out


def block_links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix of the pairs whose Jaccard similarity reaches ``percent``."""
    n = np.array([len(s) for s in sets], float)
    both = overlaps(sets)
    links = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    np.fill_diagonal(links, False)
    return links


def smallest_reachable(links: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per row the smallest id in its connected component."""
    label = ids.copy()
    top = np.iinfo(ids.dtype).max
    while True:
        best = np.minimum(label, np.where(links, label[None, :], top).min(axis=1))
        if (best == label).all():
            return label
        label = best


def _grouped(batches, key: str):
    """Rows (as dicts of lists) of each run of equal ``key`` in sorted batches."""
    held, now = None, None
    for b in batches:
        keys = b.column(key).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for a, z in zip(cuts[:-1], cuts[1:]):
            if a == z:
                continue
            part = b.slice(a, z - a)
            if held is not None and now == keys[a]:
                held.append(part)
            else:
                if held is not None:
                    yield pa.Table.from_batches(held)
                held, now = [part], keys[a]
    if held is not None:
        yield pa.Table.from_batches(held)


def _classes(rows: DataFrame, k: int, sketch: int) -> tuple[DataFrame, np.ndarray]:
    """((_id, _tk, c, n, sig) of every document, how often shingles occur). The frequencies
    are counted over all documents in ``sketch`` counters by the shingle's hash; each task adds
    its own up and sends them in stripes, which are added up in parallel."""
    id_type = rows.schema["_id"].dataType.simpleString()
    step = sketch // _STRIPES
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = ["_id", "_tk", "c", "n", "stripe", "counts", "sig"]

    def scan(batches):
        counts, id_kind = np.zeros(sketch, np.int32), None
        for b in batches:
            c, n, sig = [], [], []
            for t in b.column("_text"):
                s = shingles(t.as_py(), k)
                c.append(class_of(s) if len(s) else None)
                n.append(len(s))
                sig.append(parity(s) if len(s) else None)
                np.add.at(counts, (s & np.uint64(sketch - 1)).astype(np.int64), 1)
            id_kind = b.column("_id").type
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_tk"), pa.array(c, kinds[0]), pa.array(n, kinds[1]),
                                              pa.nulls(len(c), kinds[2]), pa.nulls(len(c), kinds[3]), pa.array(sig, kinds[4])], names=names)
        if id_kind is not None:
            for i in range(_STRIPES):
                part = counts[i * step:(i + 1) * step]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(1, id_kind), pa.nulls(1, kinds[0]), pa.nulls(1, kinds[0]), pa.nulls(1, kinds[1]), pa.array([i], kinds[2]),
                         pa.array([zlib.compress(part.tobytes(), 1)], kinds[3]), pa.nulls(1, kinds[4])], names=names)

    def add(batches):
        total = {}
        for b in batches:
            for i, x in zip(b.column("stripe").to_pylist(), b.column("counts")):
                part = np.frombuffer(zlib.decompress(x.as_py()), np.int32)
                total[i] = total.get(i, 0) + part.astype(np.int64)
        yield pa.RecordBatch.from_pydict({"stripe": pa.array(list(total), pa.int32()),
                                          "counts": pa.array([zlib.compress(v.tobytes(), 1) for v in total.values()], pa.binary())})
    both = frozen(rows.select("_id", "_tk", "_text").mapInArrow(scan, f"_id {id_type}, _tk long, c long, n int, stripe int, counts binary, sig binary"))
    sums = (both.where("stripe IS NOT NULL").select("stripe", "counts").repartition(_STRIPES, "stripe")
                .mapInArrow(add, "stripe int, counts binary").collect())
    frequency = np.zeros(sketch, np.int64)
    for r in sums:
        frequency[r.stripe * step:(r.stripe + 1) * step] = np.frombuffer(zlib.decompress(r.counts), np.int64)
    return both.where("stripe IS NULL").select("_id", "_tk", "c", "n", "sig"), np.minimum(frequency, np.iinfo(np.int32).max).astype(np.int32)


def _candidate_edges(rows: DataFrame, sets: DataFrame, k: int, percent: int, frequency, list_docs: int) -> DataFrame:
    """Edges (a, b) that join the classes which share a shingle of their prefixes and
    whose parities allow a link, as labels within a shingle's list. In a list,
    classes are sorted by size; where the next is too large for the one before
    it, no pair across the gap can link, and another list begins. Lists of more than
    ``list_docs`` classes are joined as a whole."""
    def entries(batches):
        seen = set()  # a class once for each task: copies of a document add nothing
        freq = frequency.value
        for b in batches:
            cs, ns, ps = [], [], []
            for t in b.column("_text"):
                s = shingles(t.as_py(), k)
                if len(s) and (c := class_of(s)) not in seen:
                    seen.add(c)
                    p = prefix(s, freq, percent)
                    ps.append(p.view(np.int64))
                    cs.append(np.full(len(p), c, np.int64))
                    ns.append(np.full(len(p), len(s), np.int32))
            if ps:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ps, cs, ns)], names=["h", "c", "n"])

    def members(batches):
        held = None  # the last row, not yet known to have a follower: h, c, n, whether it opens a list, head
        for b in batches:
            h, c, n = (b.column(x).to_numpy() for x in ("h", "c", "n"))
            if held is not None:
                h, c, n = (np.concatenate([[x], y]) for x, y in zip(held, (h, c, n)))
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            h, c, n = h[new], c[new], n[new]
            if not len(h):
                continue
            opens = np.ones(len(h), bool)
            opens[1:] = (h[1:] != h[:-1]) | (100 * n[:-1].astype(np.int64) < percent * n[1:].astype(np.int64))
            if held is not None:
                opens[0] = held[3]
            head = c[np.maximum.accumulate(np.where(opens, np.arange(len(h)), 0))]
            if held is not None and not held[3]:
                head[:np.argmax(opens) if opens.any() else len(h)] = held[4]
            shared = ~opens
            shared[:-1] |= ~opens[1:]
            held = h[-1], c[-1], n[-1], bool(opens[-1]), head[-1]
            yield pa.RecordBatch.from_arrays([pa.array((h * _ODD ^ head)[:-1][shared[:-1]]), pa.array(c[:-1][shared[:-1]])], names=["run", "c"])
        if held is not None and not held[3]:
            yield pa.RecordBatch.from_arrays([pa.array([int(held[0] * _ODD ^ held[4])], pa.int64()), pa.array([int(held[1])], pa.int64())],
                                             names=["run", "c"])

    def joined(batches):
        now, held = None, ([], [], [])
        a, b = [], []

        def close():
            c, n, sig = held
            if len(c) <= _FEW:
                label = few_labels(c, n, sig, percent)
            elif len(c) <= list_docs:
                label = smallest_reachable(may_link(sig, np.array(n), percent), np.array(c)).tolist()
            else:
                label = [min(c)] * len(c)
            for x, y in zip(c, label):
                if x != y:
                    a.append(x)
                    b.append(y)
        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("c", "n", "sig")]
            runs = batch.column("run").to_numpy()
            cuts = [0, *(np.flatnonzero(runs[1:] != runs[:-1]) + 1).tolist(), len(runs)]
            for i, j in zip(cuts, cuts[1:]):
                if i < j:
                    if runs[i] != now:
                        close()
                        now, held = runs[i], ([], [], [])
                    for x, y in zip(held, columns):
                        x.extend(y[i:j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []
        close()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    lists = rows.select("_text").mapInArrow(entries, "h long, c long, n int")
    runs = lists.repartition("h").sortWithinPartitions("h", "n", "c").mapInArrow(members, "run long, c long")
    return (runs.join(sets.select("c", "n", "sig"), "c").repartition("run").sortWithinPartitions("run", "c")
                .mapInArrow(joined, "a long, b long").distinct())


def _blocks(nodes: DataFrame, percent: int, block_docs: int, block_shingles: int) -> DataFrame:
    """(c, m, block, side): the blocks in which a class takes part. A small
    candidate component is one block. A larger one is cut into chunks by size and
    hash, and each pair of chunks whose sizes may link is a block."""
    total = nodes.groupBy("comp").agg(F.count(F.lit(1)).alias("_docs"), F.sum("n").alias("_all"))
    sized = nodes.join(total, "comp")
    small = (F.col("_docs") <= block_docs) & (F.col("_all") <= block_shingles)
    one = sized.where(small).select("c", "m", F.xxhash64("comp").alias("block"), F.lit(0).alias("side"))
    big = sized.where(~small).withColumn("_size", F.floor(F.log("n") / math.log(100 / percent)).cast("int"))
    half = big.groupBy("comp", "_size").agg(F.greatest(F.ceil(F.count(F.lit(1)) * 2 / block_docs), F.ceil(F.sum("n") * 2 / block_shingles))
                                            .cast("int").alias("_k"))
    up = half.select("comp", (F.col("_size") - 1).alias("_size"), F.col("_k").alias("_up"))
    down = half.select("comp", (F.col("_size") + 1).alias("_size"), F.col("_k").alias("_down"))
    chunk = F.pmod(F.xxhash64("c"), F.col("_k")).cast("int")

    def others(size, number):
        return F.when(F.coalesce(number, F.lit(0)) > 0, F.transform(
            F.sequence(F.lit(0), number - 1), lambda i: F.struct(size.alias("size"), i.cast("int").alias("i")))).otherwise(
                F.array().cast("array<struct<size:int,i:int>>"))
    mine = F.struct(F.col("_size").alias("size"), F.col("_chunk").alias("i"))
    pairs = (big.join(half, ["comp", "_size"]).join(up, ["comp", "_size"], "left").join(down, ["comp", "_size"], "left")
                .withColumn("_chunk", chunk)
                .select("c", "m", "comp", mine.alias("_me"), F.explode(F.concat(
                    others(F.col("_size"), F.col("_k")), others(F.col("_size") + 1, F.col("_up")),
                    others(F.col("_size") - 1, F.col("_down")))).alias("_it")))
    return one.unionByName(pairs.select(
        "c", "m", F.xxhash64("comp", F.least("_me", "_it"), F.greatest("_me", "_it")).alias("block"),
        F.when(F.col("_me") == F.col("_it"), 0).when(F.col("_me") < F.col("_it"), 1).otherwise(2).alias("side")))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id, n_links.

    Words are runs without white space, A-Z in lower case; a document's set holds
    its distinct runs of ``k`` words, or all its words as one run if they are
    fewer. Documents link when 100 x shared >= ``percent`` x united. component_id
    is the smallest id reachable by links, n_links the number of rows linked with
    the row. Without a word (null or empty text) a document is alone. A null id
    is larger than any other; repeated rows link with each other. An empty table
    gives an empty result; other columns are ignored.

    Documents with equal sets are one class (64-bit hash of the set). Classes that
    share a shingle of their prefixes, and whose sizes and parities of shingles in bins
    allow a link, are joined to candidate components; only the sets of classes
    in one are shuffled. Each component is multiplied in
    blocks of at most ``block_docs`` classes and ``block_shingles`` shingles; a larger one in
    pairs of chunks whose sizes allow a link. Every pair that may link meets in a
    block and is counted exactly; blocks return components, never pairs.
    """
    found = _component_rows(docs, k, percent, id_col, text_col, **options)
    return found.select(F.col("_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id", "n_links")


def _component_rows(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str, sketch: int = 1 << 20, block_docs: int = 2048,
                    block_shingles: int = 1 << 21, list_docs: int = 2048, salts: int = 32, max_bits: int = 1 << 26) -> DataFrame:
    """(_id, _tk, n, _key, component_id, n_links): with the hash of the text and the
    number of the component, null without a word."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).withColumn("_tk", F.xxhash64("_text"))
    base, counts = _classes(rows, k, sketch)
    frequency = spark.sparkContext.broadcast(counts)
    sizes = frozen(base.where("c IS NOT NULL").groupBy("c").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    near = components(_candidate_edges(rows, sizes, k, percent, frequency, list_docs))
    nodes = frozen(near.select(F.col("node").alias("c"), F.col("label").alias("comp")).join(sizes.drop("sig"), "c"))
    placed = frozen(_blocks(nodes, percent, block_docs, block_shingles))
    bits = max(1 << 20, min(max_bits, 1 << (16 * nodes.count() + 1).bit_length()))

    def sets(batches):
        seen = set()
        for b in batches:
            cs, ss = [], []
            for t in b.column("_text"):
                s = shingles(t.as_py(), k)
                if len(s) and (c := class_of(s)) not in seen:
                    seen.add(c)
                    cs.append(c)
                    ss.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cs, pa.int64()), pa.array(ss, pa.binary())], names=["c", "s"])
    h = F.xxhash64("c")
    found = marked(rows.select("_text").mapInArrow(sets, "c long, s binary"), key_bitmap(nodes, h, bits), h, bits, "_maybe")

    def product(batches):
        for t in _grouped(batches, "block"):
            c = t.column("c").to_numpy()
            first = np.concatenate([[True], c[1:] != c[:-1]])
            c, m, side = c[first], t.column("m").to_numpy()[first], t.column("side").to_numpy()[first]
            own = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("s").filter(pa.array(first))]
            if len(c) < 2:
                continue
            links = block_links(own, percent)
            if side.any():
                links &= side[:, None] != side[None, :]
            label = smallest_reachable(links, c)
            linked = links.any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(c[linked]), pa.array(label[linked]), pa.array((links @ m)[linked].astype(np.int64))],
                                             names=["a", "b", "links"])
    links = frozen(found.where("_maybe").select("c", "s").join(placed, "c").repartition("block").sortWithinPartitions("block", "c")
                        .mapInArrow(product, "a long, b long, links long"))
    labels = components(links.select("a", "b")).join(
        links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links")), "node", "left")
    full = (base.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)))
                .join(labels.withColumnRenamed("node", "c"), "c", "left")
                .join(sizes.select("c", "m"), "c", "left")
                .withColumn("_key", F.coalesce("label", "c")))
    parts = full.where("_key IS NOT NULL").groupBy("_key", "_salt").agg(F.min("_id").alias("_min"))
    least = parts.select("_key", "_salt").join(parts.groupBy("_key").agg(F.min("_min").alias("_least")), "_key")
    return (full.join(least, ["_key", "_salt"], "left")
                .select("_id", "_tk", "n", "_key", F.coalesce("_least", "_id").alias("component_id"),
                        (F.coalesce("links", F.lit(0)) + F.coalesce("m", F.lit(1)) - 1).cast("long").alias("n_links")))


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component (``jaccard_components``): the
    smallest id's, and one of the rows that share or repeat it. Documents without
    a word all stay, but for repeated rows. All columns unchanged."""
    found = _component_rows(docs, k, percent, id_col, text_col, **options)
    first = (found.where(F.col("_id").eqNullSafe(F.col("component_id")))
                  .groupBy("_key", "_id", F.when(F.col("_key").isNull(), F.col("_tk")).alias("_own")).agg(F.min("_tk").alias("_tk")))
    return keep_rows(docs, first.select("_id", "_tk"), id_col, text_of(text_col))


@query("op9_ngram_jaccard_join")
def op9_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)
