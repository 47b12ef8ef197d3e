"""Access to the parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.session import configure

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of one table; projections and filters applied later are
    pushed into the scan by Catalyst."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """``t = Tables(spark, dir); t.lineitem`` - lazily created scans."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
