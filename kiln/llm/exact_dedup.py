"""Exact deduplication by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import frozen, keep_rows, key_bitmap, marked, squeezed, table, text_of
from kiln.llm.registry import query


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 128,
                 bits: int = 1 << 22, salts: int = 32, carry: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, keep_id, group_size, kept, full_hash.

    Texts are equal when identical after each run of white space became one
    space; null counts as empty. Rows are grouped by length and a hash of the
    first ``prefix_chars`` characters; only rows of groups with more than one
    member get a SHA-256 of their whole text (``full_hash``, else null) and are
    grouped by it. The surviving groups reach the second scan as a bitmap of
    ``bits`` bits, so a few others get a hash they don't need.

    keep_id is the smallest id of the group (a null id is the largest; null if
    all are null), kept says whether the row has it: rows that repeat id and
    text get the same answer. An empty table gives an empty result. Other
    columns are ignored; ``carry`` maps output names to expressions over
    ``docs`` that are returned as well.

    Only narrow rows are shuffled. Groups are counted per (hash, salt of the id)
    first, so that a group of any size is spread over ``salts`` keys.
    """
    carry = carry or {}
    base = docs.select(F.col(id_col).alias("_id"), squeezed(text_col).alias("_t"),
                       *[e.alias(f"_carry_{k}") for k, e in carry.items()])
    keyed = (base.withColumn("_len", F.length("_t"))
                 .withColumn("_pre", F.xxhash64(F.substring("_t", 1, prefix_chars))))
    h = F.xxhash64("_len", "_pre")
    alive = keyed.groupBy("_len", "_pre").count().where(F.col("count") > 1)
    full = marked(keyed, key_bitmap(alive, h, bits), h, bits, "_alive")
    rows = frozen(full.withColumn("_full", F.when(F.col("_alive"), F.sha2("_t", 256)))
                      .withColumn("_key", F.coalesce("_full", F.concat_ws("#", F.col("_len"), F.col("_pre"))))
                      .withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)))
                      .select("_id", "_key", "_salt", "_full", *[f"_carry_{k}" for k in carry]))
    parts = rows.groupBy("_key", "_salt").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_min"))
    whole = parts.groupBy("_key").agg(F.sum("_n").alias("group_size"), F.min("_min").alias("keep_id"))
    groups = parts.select("_key", "_salt").join(whole, "_key")
    return (rows.join(groups, ["_key", "_salt"])
                .select(F.col("_id").alias(id_col), "keep_id", "group_size",
                        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("_full").alias("full_hash"),
                        *[F.col(f"_carry_{k}").alias(k) for k in carry]))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts: the smallest id's, and
    one of the rows that repeat it. All columns stay; see ``exact_groups``."""
    found = exact_groups(docs, id_col, text_col, carry={"_tk": F.xxhash64(squeezed(text_col)), "_raw": F.xxhash64(text_of(text_col))}, **options)
    first = (found.where("kept").groupBy(F.col(id_col).alias("_id"), "_tk").agg(F.min("_raw").alias("_raw")))
    return keep_rows(docs, first.select("_id", F.col("_raw").alias("_tk")), id_col, text_of(text_col))


@query("op4_exact_dedup", r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
""")
def op4_exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return exact_groups(docs, carry={"text_sha256": F.sha2(squeezed("text"), 256)}).drop("full_hash")
