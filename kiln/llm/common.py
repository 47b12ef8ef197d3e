"""Helpers shared by the operators: white space, text columns, bounded bitmaps.

White space everywhere means the six characters space, \\t, \\n, \\v, \\f and \\r.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import checkpoint_root, freed_shuffles

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def packed(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one, so that none meets a name of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def squeezed(col) -> Column:
    """The text with each run of white space replaced by one space."""
    return F.regexp_replace(text_of(col), SPACE, " ")


def frozen(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there. What it
    shuffled is dropped."""
    checkpoint_root(df.sparkSession)
    with freed_shuffles(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def _slot(h: Column, bits: int) -> Column:
    return F.pmod(h, F.lit(bits))


def key_bitmap(keys: DataFrame, h: Column, bits: int) -> DataFrame:
    """Set of hashes as a bitmap of a fixed number of ``bits``: rows (word, mask),
    ``bits / 64`` of them at most, whatever the number of keys."""
    slot = _slot(h, bits)
    return (keys.select(F.floor(slot / 64).alias("_bm_word"),
                        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int")).alias("_bm_bit"))
                .groupBy("_bm_word").agg(F.bit_or("_bm_bit").alias("_bm_mask")))


def bitmap_array(bitmap: DataFrame, bits: int) -> np.ndarray:
    """The bitmap as an array of ``bits / 64`` words, for tasks in Python."""
    t = bitmap.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[t.column("_bm_word").to_numpy()] = t.column("_bm_mask").to_numpy()
    return out


def in_bitmap(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bitmap may hold each of the hashes ``h``."""
    slot = h % (len(words) * 64)
    return (words[slot // 64] >> (slot % 64)) & 1 == 1


def marked(df: DataFrame, bitmap: DataFrame, h: Column, bits: int, name: str) -> DataFrame:
    """Add boolean ``name``: whether the bitmap may hold the hash. Never false
    for a member; true for some others, more of them the fuller the bitmap. The
    broadcast side has ``bits / 64`` rows at most."""
    slot = _slot(h, bits)
    return (df.withColumn("_bm_slot", slot)
              .join(F.broadcast(bitmap), F.floor(F.col("_bm_slot") / 64) == F.col("_bm_word"), "left")
              .withColumn(name, F.coalesce(F.call_function(
                  "getbit", F.col("_bm_mask"), F.pmod(F.col("_bm_slot"), F.lit(64)).cast("int")) == 1, F.lit(False)))
              .drop("_bm_slot", "_bm_word", "_bm_mask"))


def keep_rows(docs: DataFrame, keep: DataFrame, id_col: str, text: Column) -> DataFrame:
    """The rows of ``docs`` whose id and hash of ``text`` are in ``keep`` (_id, _tk),
    one of each that repeat both; all columns unchanged. Rows are told apart by a
    hash, so texts are shuffled once; those that repeat are looked for first and
    taken out by themselves."""
    tagged = docs.select(packed(docs), F.col(id_col).alias("_rid"), F.xxhash64(text).alias("_rtk"))
    wanted = frozen(keep.select("_id", "_tk").distinct())
    same = F.col("_rid").eqNullSafe(F.col("_id")) & F.col("_rtk").eqNullSafe(F.col("_tk"))
    again = frozen(tagged.groupBy(F.col("_rid").alias("_id"), F.col("_rtk").alias("_tk")).count().where("count > 1").select("_id", "_tk"))
    kept = tagged.join(wanted.hint("shuffle_hash"), same, "left_semi")
    if not again.isEmpty():
        repeats = kept.join(again, same, "left_semi").dropDuplicates(["_rid", "_rtk"])
        kept = kept.join(again, same, "left_anti").unionByName(repeats)
    return kept.select("_row.*")
