"""Session set-up and shared-storage locations."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "kiln") -> SparkSession:
    """Local/test session builder. On a cluster use the session you are given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", os.environ.get("KILN_DRIVER_MEMORY", "16g")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Set the session's time zone to UTC, on which the dates in results depend.
    Adaptive execution and its handling of skewed joins, on by default in Spark,
    are left as the cluster sets them."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may go without: a private temporary folder then becomes
    the context's checkpoint directory (the setting itself cannot be changed at
    run time) and is removed when Python ends; later calls find it through the
    context. On a cluster a missing setting is an error, since executors do not
    see the driver's disk.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        current = sc.getCheckpointDir()
        if current:  # <root>/<context id>, set by an earlier call
            return current.rstrip("/").rsplit("/", 1)[0]
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="kiln-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/kiln-{name}-{uuid.uuid4().hex[:12]}"


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Plans made in the block drop their shuffle files as soon as they have run. For
    those whose result is stored: Spark otherwise keeps the files until the driver
    collects its garbage. Versions before 4.1 ignore the setting."""
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def spread(df):
    """A scan whose files are too few to occupy the cluster, dealt to its cores.
    For callers that read a table as it lies, such as a file of one row group; a
    large table has more splits than this and is returned as is."""
    target = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
