"""Corpus pipeline: quality, exact and near duplicates, benchmark leaks, mixture.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns
those it keeps. All stages but the last return the columns of ``docs``; the last
adds ``epoch``, the repetition's number, to rows that may occur more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm.common import table
from kiln.llm.decontaminate import clean_documents
from kiln.llm.exact_dedup import exact_dedup
from kiln.llm.mixing import mix_sources
from kiln.llm.ngram_join import near_dedup
from kiln.llm.quality import good_documents
from kiln.session import freed_shuffles, scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on ``labels``, scores 0.5 or more."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of documents that share four fifths of their
    runs of five words."""
    return near_dedup(docs, k=5, percent=80)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in proportion 3, 1, 2, repeating, at 1.5 times all words and at
    most two epochs each."""
    return mix_sources(docs)


STAGES = [("quality_classifier", quality), ("exact_dedup", exact), ("ngram_jaccard_join", near),
          ("benchmark_decontamination", leaks), ("mixing", mixture)]

#: The classifier and the alignments are not SQL; tests/llm hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage keeps is written to the shared
    checkpoint folder as Parquet and read by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        kept = stage(spark, docs, sf_dir)
        with freed_shuffles(spark):
            kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
