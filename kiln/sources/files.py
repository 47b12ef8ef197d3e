"""Readers and writers (S1-S8): delimited text, bounded reads, cached tables,
labelled folders, model persistence and formatted reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from kiln.functions.columns import fmt2


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sep: str = ",", header: bool = True, na: str = "NA") -> DataFrame:
    """Header CSV; declared ``schema`` (preferred) or inferred types.
    Unquoted empty fields and ``na`` are missing values, as in R and pandas;
    CRLF line ends are accepted."""
    r = (spark.read.option("header", header).option("sep", sep)
              .option("nullValue", na).option("mode", "PERMISSIVE"))
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_tsv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, na: str = "NA") -> DataFrame:
    """Tab-separated text with a header."""
    return read_csv(spark, path, schema, sep="\t", header=header, na=na)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def read_head(df: DataFrame, n: int, order) -> DataFrame:
    """S3: the first ``n`` rows in ``order`` (a bounded top-k; needs a total
    order for a stable result)."""
    order = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*order).limit(n)


def cached_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet at ``path`` unless a readable table is
    there, then read it; a second call reuses the table.

    Files reach ``path`` only when a write job commits, so a folder left by a
    failed job has no readable table and is written again (overwrite).
    """
    spark = df.sparkSession
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def read_labelled_dir(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """One row per file below ``path``; label = name of the file's folder,
    class index = 0-based alphabetical rank of the label (as image loaders do).

    The labels are few (one per folder); their ranking is a small window.
    """
    from pyspark.sql import Window
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    cols = ["path", "length"] + (["content"] if content else [])
    lab = df.select(*cols, F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("label"))
    levels = lab.select("label").distinct().withColumn(
        "class_index", (F.dense_rank().over(Window.orderBy("label")) - 1).cast("int"))
    return lab.join(F.broadcast(levels), "label")


def save_model(model, path: str) -> None:
    """Persist a fitted model/pipeline (overwrites)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a saved ``PipelineModel``."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def report(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Every floating-point/decimal column as text with ``decimals`` places."""
    out = []
    for c, t in df.dtypes:
        if t in ("double", "float") or t.startswith("decimal"):
            out.append(fmt2(F.col(f"`{c}`"), decimals).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)
