"""Global positions and prefix sums without funnelling rows into one task.

A window with ``orderBy`` and no ``partitionBy`` moves every row into a single
task. Here rows are range-partitioned on the order key, sorted inside each
partition and numbered locally; each partition is then shifted by the total
size of the partitions before it. Only the per-partition sizes (one row per
partition) are combined in one place.

The numbered frame is frozen with a reliable ``checkpoint`` (the shared folder
of ``spark.checkpoint.dir``) before the sizes are taken: range bounds come from
a sample, and a second evaluation of an unmaterialised plan - possibly with
other columns pruned, or after an executor loss - could draw other bounds and
break the offsets. Checkpointing also cuts the lineage.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import checkpoint_root

_P, _M, _O, _L = "_kiln_p", "_kiln_m", "_kiln_o", "_kiln_l"


def _n_parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _as_cols(order) -> list[Column]:
    if isinstance(order, (str, Column)):
        order = [order]
    return [F.col(c) if isinstance(c, str) else c for c in order]


@contextmanager
def _held(df: DataFrame):
    """Keep ``df`` cached only while the eager checkpoint runs: the range
    sample and the checkpoint then read it once instead of recomputing its
    plan; it is released as soon as the checkpoint is written."""
    if df.is_cached:  # the caller's cache stays the caller's
        yield df
        return
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _offsets(sizes: DataFrame, total: str) -> DataFrame:
    # one row per partition: the running total is tiny whatever the data size
    return sizes.select(_P, F.coalesce(
        F.sum(total).over(Window.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias(_O))


def row_index(df: DataFrame, order, name: str = "row_id", start: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Add the position of each row in ``order`` (``start``-based).

    ``order`` should be a total order (add tie-break columns); ties get
    positions in an unspecified order, as with ``row_number()``. Runs one job
    at call time (the checkpoint).
    """
    cols = _as_cols(order)
    n = _n_parts(df, num_partitions)
    checkpoint_root(df.sparkSession)
    with _held(df) as src:
        tagged = (src.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                     .withColumn(_P, F.spark_partition_id())
                     .withColumn(_M, F.monotonically_increasing_id())
                     .checkpoint(eager=True))
    sizes = tagged.groupBy(_P).agg(F.count(F.lit(1)).alias(_L))
    local = F.col(_M) - F.shiftleft(F.col(_P).cast("long"), 33)
    return (tagged.join(F.broadcast(_offsets(sizes, _L)), _P)
                  .withColumn(name, F.col(_O) + local + F.lit(start))
                  .drop(_P, _M, _O))


def dense_index(df: DataFrame, cols, name: str = "level", start: int = 1,
                order=None, num_partitions: int | None = None) -> DataFrame:
    """Distinct values of ``cols`` numbered in sorted order (``start``-based).

    Returns ``cols + [name]``: a level table to join back to the data. The
    numbering is a ``dense_rank`` computed without a single-task window.
    """
    if isinstance(cols, str):
        cols = [cols]
    levels = df.select(*cols).distinct()
    return row_index(levels, order or [F.col(c).asc_nulls_last() for c in cols],
                     name=name, start=start, num_partitions=num_partitions)


def prefix_sum(df: DataFrame, order, weight: str, name: str = "offset",
               num_partitions: int | None = None) -> DataFrame:
    """Exclusive running total of ``weight`` in ``order`` (first row gets 0)."""
    cols = _as_cols(order)
    n = _n_parts(df, num_partitions)
    checkpoint_root(df.sparkSession)
    with _held(df) as src:
        tagged = (src.repartitionByRange(n, *cols)
                     .withColumn(_P, F.spark_partition_id())
                     .checkpoint(eager=True))
    # rows of one range partition are numbered by a window on the partition id
    w_local = Window.partitionBy(_P).orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumn(_L, F.coalesce(F.sum(weight).over(w_local), F.lit(0)))
    sizes = tagged.groupBy(_P).agg(F.sum(weight).alias("_kiln_s"))
    return (local.join(F.broadcast(_offsets(sizes, "_kiln_s")), _P)
                 .withColumn(name, F.col(_O) + F.col(_L))
                 .drop(_P, _O, _L))


def running_sums(df: DataFrame, group, order, weights: dict[str, str], num_partitions: int | None = None) -> DataFrame:
    """Inclusive running totals within each group: ``weights`` maps a new column to
    the column it adds up, in the order of ``order`` (a total order in the group).

    Rows are range-partitioned on (group, order), so that a group of any size is
    spread, and added up inside each partition; a partition goes on with one group
    of the partitions before it at most, and that group's totals so far (one row
    for each partition) are joined to it.
    """
    group, order = [group] if isinstance(group, str) else list(group), _as_cols(order)
    n = _n_parts(df, num_partitions)
    checkpoint_root(df.sparkSession)
    with _held(df) as src:
        tagged = (src.repartitionByRange(n, *group, *order)
                     .withColumn(_P, F.spark_partition_id())
                     .checkpoint(eager=True))
    here = Window.partitionBy(_P, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group).orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.sum(c).alias(f"_kiln_{name}") for name, c in weights.items()]
    carried = (tagged.groupBy(_P, *group).agg(*sums)
                     .select(_P, *group, *[F.sum(f"_kiln_{name}").over(before).alias(f"_kiln_{name}") for name in weights])
                     .where(F.col(f"_kiln_{next(iter(weights))}").isNotNull()))
    local = tagged.select("*", *[F.sum(c).over(here).alias(name) for name, c in weights.items()])
    both = local.join(F.broadcast(carried), [_P, *group], "left")
    zero = F.lit(0)
    return both.select(*df.columns, *[(F.col(name) + F.coalesce(F.col(f"_kiln_{name}"), zero)).alias(name) for name in weights])


def quantiles(df: DataFrame, cols, probs, num_partitions: int | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles (R type 7 / ``percentile``) of
    each column, without holding a column's values in one task.

    The non-missing values of all columns are melted to (column, value) and
    counted, with partial aggregation, so that a value that fills half a column
    is one row from there on. A distributed running total over the distinct
    values gives each its first position; per column the two neighbouring
    positions of ``p * (n - 1)`` are looked up (columns x probabilities, broadcast)
    and interpolated. Returns (column, p, value).
    """
    spark = df.sparkSession
    cols = [cols] if isinstance(cols, str) else list(cols)
    melted = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                          for c in cols]))).where(F.col("value").isNotNull())
    counts = melted.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_c"))
    placed = prefix_sum(counts, ["column", "value"], "_c", name="_at", num_partitions=num_partitions)
    stats = placed.groupBy("column").agg(F.min("_at").alias("_first"), F.sum("_c").alias("_n"))
    ps = spark.createDataFrame([(float(p),) for p in probs], "p double").coalesce(1)
    h = F.col("p") * (F.col("_n") - 1)
    want = (stats.crossJoin(F.broadcast(ps)).withColumn("_h", h)
                 .select("column", "p", "_h", F.explode(F.array(F.col("_first") + F.floor("_h"), F.col("_first") + F.ceil("_h"))).alias("_pos")))
    wanted = want.withColumnRenamed("column", "_w")
    found = placed.join(F.broadcast(wanted), (F.col("column") == F.col("_w")) & (F.col("_at") <= F.col("_pos"))
                        & (F.col("_pos") < F.col("_at") + F.col("_c")))
    frac = F.col("_h") - F.floor("_h")
    low, high = F.min("value").alias("_lo"), F.max("value").alias("_hi")
    return (found.groupBy("column", "p", "_h").agg(low, high)
                 .select("column", "p", F.when(frac == 0, F.col("_lo"))
                         .otherwise((F.lit(1.0) - frac) * F.col("_lo") + frac * F.col("_hi")).alias("value")))
