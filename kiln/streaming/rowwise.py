"""File-source streams and a file-sink runner for per-row work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kiln.session import scratch_dir


def stream_parquet(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over the parquet files arriving in ``path``."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def run_to_files(sdf: DataFrame, path: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                 checkpoint: str | None = None) -> DataFrame:
    """Apply ``transform`` (per-row column work) to a stream, write everything
    available as parquet files to ``path`` and read them.

    The query's checkpoint lives in the shared checkpoint folder, so a restarted
    query resumes where it stopped.
    """
    spark = sdf.sparkSession
    out = transform(sdf) if transform else sdf
    (out.writeStream.format("parquet").option("path", path).outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint or scratch_dir(spark, "stream")).start().awaitTermination())
    return spark.read.schema(out.schema).parquet(path)
