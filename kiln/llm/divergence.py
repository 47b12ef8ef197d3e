"""Source divergence audit: how far each source's terms lie from the other sources' and
from the whole of its language; the leading terms come from a dominance skyband."""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import LOWER, UPPER, frozen, table, text_of
from kiln.llm.registry import query

# A term is a run of ASCII letters and code points above 127; in UTF-8 those are the bytes that stay.
_BYTES = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))
_DOC = 1 << 40
SCALE = 1_000_000_000


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                held_terms: int = 200_000) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, in
    parts: a task adds up what it reads and hands over ``held_terms`` entries at a
    time, so that a term, frequent or not, comes at most once in such a part."""
    def parts(batches):
        held: dict = {}
        size = 0
        for b in batches:
            for lang, source, text in zip(*(b.column(c).to_pylist() for c in ("lang", "source")), b.column("text")):
                own = held.setdefault((lang, source), {})
                before = len(own)
                for term, n in Counter(text.as_py().encode().translate(_BYTES).split()).items():
                    own[term] = own.get(term, 0) + n + _DOC
                size += len(own) - before
                if size >= held_terms:
                    yield from emit(held)
                    held, size = {}, 0
        yield from emit(held)

    def emit(held):
        for (lang, source), own in held.items():
            if own:
                packed = np.fromiter(own.values(), np.int64, len(own))
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.repeat(pa.scalar(lang), len(own)), "source": pa.repeat(pa.scalar(source), len(own)),
                    "term": pa.array(list(own), pa.binary()).cast(pa.string()), "n": packed % _DOC, "docs": packed // _DOC})
    plain = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text"))
    return plain.mapInArrow(parts, "lang string, source string, term string, n long, docs long")


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, total, sources): the terms in ``min_docs`` documents of their
    language or more, with the count of each source that has them, by source. Parts
    meet once, dealt by language and term; both groupings follow in place."""
    each = (counts.repartition("lang", "term").groupBy("lang", "term", "source")
                  .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (each.groupBy("lang", "term")
                .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("sources"))
                .where(F.col("docs") >= min_docs).drop("docs"))


# -- skyband ------------------------------------------------------------------

class Band:
    """The rows of one group met so far that fewer than ``k`` others dominate. Rows
    come by falling ``higher``, rising ``lower`` and rising place in the text order;
    whatever dominates a row has come before it."""

    def __init__(self, k: int):
        self.k = k
        self.lower, self.place = np.empty(0, np.int64), np.empty(0, np.int64)

    def admit(self, lower: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which of the next rows stay. It is enough to count dominators that
        stayed: one that did not is dominated by k that dominate the row too."""
        out = np.zeros(len(lower), bool)
        for a in range(0, len(lower), 8192):
            z = min(a + 8192, len(lower))
            left = a + np.flatnonzero(place[a:z] <= self._limits(lower[a:z]))
            for b in range(0, len(left), 512):
                rows = left[b:b + 512]
                lo, pl = lower[rows], place[rows]
                n = ((self.lower <= lo[:, None]) & (self.place < pl[:, None])).sum(1)
                n += np.tril((lo <= lo[:, None]) & (pl < pl[:, None]), -1).sum(1)
                good = rows[n < self.k]
                out[good] = True
                self.lower, self.place = np.concatenate([self.lower, lower[good]]), np.concatenate([self.place, place[good]])
        return out

    def _limits(self, lower: np.ndarray) -> np.ndarray:
        """For each row the k-th smallest place among those kept with no larger
        ``lower``: a row placed after it is dominated by k at least."""
        order = np.argsort(self.lower, kind="stable")
        heap: list[int] = []
        limit = np.full(len(order) + 1, np.iinfo(np.int64).max)
        for i, p in enumerate(self.place[order].tolist()):
            if len(heap) < self.k:
                heapq.heappush(heap, -p)
            else:
                heapq.heappushpop(heap, -p)
            if len(heap) == self.k:
                limit[i + 1] = -heap[0]
        return limit[np.searchsorted(self.lower[order], lower, "right")]


def _segments(batch: pa.RecordBatch, names) -> list[tuple[tuple, int, int]]:
    """(key, from, to) of the stretches of rows with one key."""
    change = np.zeros(batch.num_rows, bool)
    change[:1] = True
    for c in names:
        codes = batch.column(c).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        change[1:] |= codes[1:] != codes[:-1]
    at = np.flatnonzero(change).tolist() + [batch.num_rows]
    return [(tuple(batch.column(c)[a].as_py() for c in names), a, z) for a, z in zip(at, at[1:])]


def _local_band(df: DataFrame, group: list[str], higher: str, lower: str, text: str, k: int) -> DataFrame:
    """The skyband of each group's rows within each partition, streamed."""
    def bands(batches):
        key, band = None, None
        for b in batches:
            lo, place = b.column(lower).to_numpy(), b.column("_place").to_numpy()
            keep = np.zeros(b.num_rows, bool)
            for own, a, z in _segments(b, group):
                if own != key:
                    key, band = own, Band(k)
                keep[a:z] = band.admit(lo[a:z], place[a:z])
            if keep.any():
                yield b.filter(pa.array(keep)).select(names)
    names = [*group, higher, lower, text]
    placed = (df.select(*names).sortWithinPartitions(text).withColumn("_place", F.monotonically_increasing_id())
                .sortWithinPartitions(*group, F.desc(higher), lower, "_place"))
    return placed.mapInArrow(bands, df.select(*names).schema)


def skyband(df: DataFrame, group: list[str], higher: str, lower: str, text: str, k: int, part_rows: int = 250_000) -> DataFrame:
    """The rows of each group that fewer than ``k`` others of it dominate: others
    with a ``higher`` no smaller, a ``lower`` no larger and an earlier ``text``
    (UTF-8 order; texts of a group differ, nothing is null). Whatever measure rises
    with ``higher``, falls with ``lower`` and breaks ties by text, its first ``k``
    are among them.

    Groups are dealt to partitions in as many parts, by a hash of the text, as the
    largest one has ``part_rows`` rows (smaller parts would hardly drop anything).
    Each keeps its skyband; then those of a group are merged. A task holds two
    numbers for each row of a skyband, never a group.
    """
    largest = df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    parts = -(-largest // part_rows)
    if parts > 1:
        df = _local_band(df.repartition(*group, F.pmod(F.xxhash64(text), F.lit(parts))), group, higher, lower, text, k)
    return _local_band(df.repartition(*group), group, higher, lower, text, k)


# -- measures -----------------------------------------------------------------

def share(n: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (n + 1) / total), also where the product passes 63 bits."""
    if len(n) and int(n.max()) >= (1 << 63) // SCALE - 1:
        return np.array([1 + SCALE * (x + 1) // total for x in n.tolist()], np.int64)
    return 1 + SCALE * (n + 1) // total


def share_of(n: str, total: Column) -> Column:
    """``share`` as a column; decimals keep every digit."""
    product = F.lit(SCALE).cast("decimal(10,0)") * (F.col(n) + 1).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", product, total.cast("decimal(20,0)"))


def pair_values(terms: DataFrame, heads: DataFrame, parts: int, cells: int = 1 << 20) -> DataFrame:
    """(lang, source, item, value) of all pairs of sources of a language: the sum
    of floor((p - q)^2 / q) over its terms, p being the source's share and q the item's.

    Terms are dealt by hash to as many parts as there are ``cells`` shares, at most
    ``parts``, so that sums grow with the terms and not with the tasks; each part gets the row of ``heads`` (lang,
    terms, sources by name with their counts) of every language. A task lays ``cells`` shares at a
    time out as a block of terms by sources and adds up its columns against each
    source; only these sums are shuffled.
    """
    def sums(batches):
        head, names, index, rows, held = None, [], {}, [], 0

        def block():
            nonlocal rows, held
            if not held:
                return
            p = np.tile(base, (held, 1))
            for offset, at, which, values in rows:
                p[offset + at, which] = values
            for s, source in enumerate(names):
                d = p[:, s:s + 1] - p
                yield result(source, (d * d // p).sum(0))
            rows, held = [], 0

        def result(source, values):
            return pa.RecordBatch.from_pydict({"lang": pa.repeat(pa.scalar(head[0]), len(names)), "source": pa.repeat(pa.scalar(source), len(names)),
                                               "item": pa.array(names, pa.string()), "value": pa.array(values, pa.int64())})
        for b in batches:
            for (lang, is_term), a, z in _segments(b, ["lang", "is_term"]):
                part = b.slice(a, z - a)
                if not is_term:
                    yield from block()
                    head = (lang, part.column("terms")[0].as_py())
                    names = part.column("names")[0].as_py()
                    index = {name: i for i, name in enumerate(names)}
                    total = np.array(part.column("counts")[0].as_py(), np.int64) + head[1]
                    if head[1]:
                        base = 1 + SCALE // total
                    if part.column("part")[0].as_py() == 0:
                        for source in names:
                            yield result(source, np.zeros(len(names), np.int64))
                    continue
                most = max(1, cells // len(names))
                while part.num_rows:
                    take = part.slice(0, most - held)
                    part = part.slice(take.num_rows)
                    lists = take.column("names")
                    codes = lists.flatten().dictionary_encode()
                    which = np.array([index[x] for x in codes.dictionary.to_pylist()])[codes.indices.to_numpy()]
                    n = take.column("counts").flatten().to_numpy()
                    sizes = np.diff(lists.offsets.to_numpy())
                    values = np.empty(len(n), np.int64)
                    for s in np.unique(which):
                        own = which == s
                        values[own] = share(n[own], int(total[s]))
                    rows.append((held, np.repeat(np.arange(take.num_rows), sizes), which, values))
                    held += take.num_rows
                    if held >= most:
                        yield from block()
        if head is not None:
            yield from block()
    shares = heads.agg(F.sum(F.col("terms") * F.size("sources"))).first()[0] or 0
    parts = max(1, min(parts, -(-shares // cells)))
    columns = ["part", "lang", "is_term", "terms", "names", "counts"]
    of_terms = terms.select(F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int").alias("part"), "lang", F.lit(True).alias("is_term"),
                            F.lit(0).cast("long").alias("terms"), F.col("sources.source").alias("names"), F.col("sources.n").alias("counts"))
    of_heads = heads.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "lang", F.lit(False).alias("is_term"),
                            "terms", F.col("sources.source").alias("names"), F.col("sources.n").alias("counts"))
    both = of_heads.select(columns).unionByName(of_terms.select(columns)).repartitionByRange(parts, "part").sortWithinPartitions("part", "lang", "is_term")
    got = both.mapInArrow(sums, "lang string, source string, item string, value long")
    return got.where("source != item").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence_audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 3,
                     top: int = 200) -> DataFrame:
    """Audit of the sources of each language: lang, source, part, item, value, rank.

    A language keeps the terms found in ``min_docs`` of its documents or more. In
    part ``pair`` the item is every other source of the language, the value the sum
    over its terms of floor((p - q)^2 / q), p and q being the source's and the
    item's smoothed shares in billionths. In part ``term`` the items are the
    ``top`` terms of the source whose share p is above the language's share q, by
    the same value. Ranks go by falling value, then by the item's UTF-8. All
    arithmetic is in whole numbers.

    Null texts, languages and sources count as empty strings; rows are documents,
    also repeated ones or those without an id. A source without terms is paired
    like others; a language with one source has no pair. An empty table gives an
    empty result, other columns are ignored.
    """
    spark = docs.sparkSession
    terms = frozen(kept_terms(term_counts(docs, text_col, lang_col, source_col), min_docs))
    each = terms.select("lang", "term", "total", F.explode("sources").alias("s")).select("lang", F.col("s.source").alias("source"), "term",
                                                                                         F.col("s.n").alias("n"), "total")
    occurring = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source")).distinct()
    words = each.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("total"))
    groups = frozen(occurring.join(words, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["n", "terms", "total"]))
    heads = groups.groupBy("lang").agg(F.first("terms").alias("terms"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("sources"))
    pairs = pair_values(terms, heads, int(spark.conf.get("spark.sql.shuffle.partitions")))
    leading = skyband(each, ["lang", "source"], "n", "total", "term", top)
    known = groups.select("lang", "source", F.col("n").alias("_n"), (F.col("n") + F.col("terms")).alias("_own"), (F.col("total") + F.col("terms")).alias("_all"))
    p, q = share_of("n", F.col("_own")), share_of("total", F.col("_all"))
    rated = (leading.join(known, ["lang", "source"]).withColumn("_p", p).withColumn("_q", q).where("_p > _q")
                    .select("lang", "source", F.col("term").alias("item"), F.expr("(_p - _q) * (_p - _q) div _q").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def part(df, name):
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return part(pairs, "pair").unionByName(part(rated, "term").where(F.col("rank") <= top))


@query("op12_divergence_audit", r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
                                 lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
k AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + v.v) AS p
      FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q FROM c GROUP BY lang, term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
part AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
         UNION ALL
         SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM part
QUALIFY part = 'pair' OR rank <= 200
""")
def op12_divergence_audit(spark, sf_dir):
    return divergence_audit(table(spark, sf_dir, "documents"))
