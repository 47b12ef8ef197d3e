"""Bounded samples of labelled rows, for the operators that fit a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(id_col, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id is in fold -1)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)), F.lit(-1)).cast("int")


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, allowed: Column, max_rows: int,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _text, _y) of labelled documents whose label satisfies ``allowed``.

    About ``max_rows`` of them: the fraction of a hash of the id that yields so
    many in expectation, so that a rerun takes the same rows. Of several labels
    of an id the largest counts; null ids and labels are left out. Only the
    sampled labels, at most about ``max_rows`` rows, are broadcast.
    """
    known = (labels.where(allowed & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
                   .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("double").alias("_y")))
    n = known.count()
    span = 1 << 30
    part = known.where(F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(span)) < int(span * min(1.0, max_rows / max(n, 1))))
    rows = docs.select(F.col(id_col).alias("_did"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.join(F.broadcast(part), F.col("_did") == F.col("_id")).select("_id", "_text", "_y")
