"""Line deduplication: range-partitioned line hashes, sorted by document and position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import LOWER, UPPER, frozen, key_bitmap, marked, packed, table, text_of
from kiln.llm.registry import query

_KEY, _DOC = ["_h1", "_h2"], ["_id", "_tk"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case (``lower`` would
    change other letters too, so it serves only lines of ASCII)."""
    bare = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _occurrences(docs: DataFrame, id_col: str, text_col: str, salts: int) -> DataFrame:
    lines = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_of(text_col)).alias("_tk"),
                        F.posexplode(F.split(text_of(text_col), "\n", -1)).alias("_pos", "_line"))
    return (lines.select(*_DOC, "_pos", line_key(F.col("_line")).alias("_k")).where("_k != ''")
                 .select(*_DOC, "_pos", F.xxhash64("_k").alias("_h1"), F.xxhash64(F.lit(1), "_k").alias("_h2"))
                 .withColumn("_salt", F.pmod(F.xxhash64(*_DOC), F.lit(salts))))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 1,
                 keep_first: bool = True, salts: int = 64, bits: int = 1 << 22) -> DataFrame:
    """The documents that lose lines, as compressed bitmaps: _id, _tk (hash of
    the text) and dropped, a map from line number / 64 to a word whose set bits
    are the dropped lines. Words without a dropped line are left out.

    A line's key is the line stripped and lower-cased (A-Z); empty keys never
    count. Keys found in ``min_docs`` documents or more lose their lines:
    all but the first by (id, text hash, position) with ``keep_first``, else all.

    Key hashes (128 bits) are range-partitioned with a salt of the document, so
    that a frequent line is spread over ``salts`` ranges, and sorted by document
    and position inside; the sorted rows are streamed once to count documents
    and to find the first occurrence. Rows of other keys are left out of the
    second pass by a bitmap of fixed size. The hashes (36 bytes a line) are written
    to the checkpoint folder, so that texts are read once.
    """
    occ = frozen(_occurrences(docs, id_col, text_col, salts))
    stream = Window.partitionBy(*_KEY, "_salt").orderBy(*_DOC, "_pos")
    doc = F.struct(*_DOC)
    ranged = (occ.repartitionByRange(*_KEY, "_salt")
                 .withColumn("_before", F.lag(F.struct(doc.alias("d"))).over(stream))
                 .withColumn("_new", F.when(F.col("_before").isNull() | ~F.col("_before.d").eqNullSafe(doc), 1).otherwise(0)))
    at = F.struct(*_DOC, "_pos")
    parts = frozen(ranged.groupBy(*_KEY, "_salt").agg(F.sum("_new").alias("_docs"), F.count(F.lit(1)).alias("_n"),
                                                      F.min(at).alias("_first")))
    whole = (parts.groupBy(*_KEY).agg(F.sum("_docs").alias("_docs"), F.sum("_n").alias("_n"), F.min("_first").alias("_first"))
                  .where((F.col("_docs") >= min_docs) & ((F.col("_n") > 1) | F.lit(not keep_first))))
    frequent = frozen(parts.select(*_KEY, "_salt").join(whole.select(*_KEY, "_first"), _KEY))
    h = F.xxhash64(*_KEY)
    hit = marked(occ, key_bitmap(frequent, h, bits), h, bits, "_maybe").where("_maybe")
    dropped = hit.join(frequent, [*_KEY, "_salt"])
    if keep_first:
        dropped = dropped.where(~at.eqNullSafe(F.col("_first")))
    words = (dropped.groupBy(*_DOC, F.floor(F.col("_pos") / 64).cast("int").alias("_w"))
                    .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_pos", F.lit(64)))).alias("_bits")))
    return words.groupBy(*_DOC).agg(F.map_from_entries(F.collect_list(F.struct("_w", "_bits"))).alias("dropped"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with columns n_lines, n_dropped and kept_text added.

    Null or empty text is one empty line. Rows that repeat id and text are one
    document and get the same answer; rows that share an id (or have none) and
    differ in text are documents of their own. An empty table gives an empty
    result. Columns of ``docs`` with the names of the added ones are replaced.
    """
    added = ("n_lines", "n_dropped", "kept_text")
    others = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    maps = keep_bitmaps(docs, id_col, text_col, **options)
    both = (others.select(packed(others), F.col(id_col).alias("_rid"), text_of(text_col).alias("_text")).withColumn("_rtk", F.xxhash64("_text"))
                  .join(maps.hint("shuffle_hash"), F.col("_rid").eqNullSafe(F.col("_id")) & (F.col("_rtk") == F.col("_tk")), "left"))
    return (both.withColumn("_lines", F.split("_text", "\n", -1))
                .withColumn("_words", F.transform(F.sequence(F.lit(0), F.floor((F.size("_lines") - 1) / 64).cast("int")),
                                                  lambda w: F.coalesce(F.try_element_at("dropped", w), F.lit(0).cast("long"))))
                .withColumn("_kept", F.when(F.col("dropped").isNull(), F.col("_text")).otherwise(F.array_join(F.filter(
                    "_lines", lambda x, i: F.call_function("getbit", F.get("_words", F.floor(i / 64).cast("int")),
                                                           F.pmod(i, F.lit(64))) == 0), "\n")))
                .withColumn("_n", F.aggregate(F.coalesce(F.map_values("dropped"), F.array().cast("array<bigint>")),
                                              F.lit(0).cast("long"), lambda s, x: s + F.bit_count(x)))
                .select("_row.*", F.size("_lines").cast("long").alias("n_lines"), F.col("_n").alias("n_dropped"), F.col("_kept").alias("kept_text")))


@query("op2_line_dedup", r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
f AS (SELECT k FROM k WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.k = f.k GROUP BY doc_id
""")
def op2_line_dedup(spark, sf_dir):
    cut = line_dedup(table(spark, sf_dir, "documents"), min_docs=10, keep_first=False)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
