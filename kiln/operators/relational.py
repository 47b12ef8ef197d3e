"""Relational verbs of the retail scripts: joins, grouped summaries, shares,
ordering, top-k with ties, sampling and binding.

R/dplyr meanings are kept where they differ from Spark defaults: ``n()`` counts
rows, sorting puts missing values last both ways, ``top_n`` keeps ties, joins
may match missing keys to each other.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.columns import hash8
from kiln.operators.indexing import row_index
from kiln.session import checkpoint_root


def _cols(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


# --- joins -----------------------------------------------------------------

def _join(l: DataFrame, r: DataFrame, by, how: str, null_safe: bool) -> DataFrame:
    by = _cols(by)
    if not null_safe:
        return l.join(r, by, how)
    # null-safe keys: join on <=> and keep one copy of each key column
    ra = r.select(*[F.col(c).alias(f"_r_{c}") if c in by else F.col(c) for c in r.columns])
    cond = reduce(lambda a, b: a & b, [l[c].eqNullSafe(ra[f"_r_{c}"]) for c in by])
    j = l.join(ra, cond, how)
    keys = [F.coalesce(l[c], ra[f"_r_{c}"]).alias(c) if how in ("right", "full") else l[c]
            for c in by]
    rest_l = [l[c] for c in l.columns if c not in by]
    rest_r = [ra[c] for c in ra.columns if not c.startswith("_r_")]
    return j.select(*keys, *rest_l, *rest_r)


def left_join(l: DataFrame, r: DataFrame, by, null_safe: bool = False) -> DataFrame:
    """Every left row, matched right columns or nulls (dplyr ``left_join``)."""
    return _join(l, r, by, "left", null_safe)


def natural_left_join(l: DataFrame, r: DataFrame, null_safe: bool = False) -> DataFrame:
    """Left join on all column names the two tables share."""
    shared = [c for c in l.columns if c in set(r.columns)]
    if not shared:
        raise ValueError("no shared columns for a natural join")
    return _join(l, r, shared, "left", null_safe)


def right_join(l: DataFrame, r: DataFrame, by, null_safe: bool = False) -> DataFrame:
    """Every right row, matched left columns or nulls."""
    return _join(l, r, by, "right", null_safe)


def merge(l: DataFrame, r: DataFrame, by) -> DataFrame:
    """Inner join, result ordered by the key (R ``merge``)."""
    by = _cols(by)
    return l.join(r, by, "inner").orderBy(*[F.col(c).asc_nulls_last() for c in by])


def semi_join(l: DataFrame, r: DataFrame, by) -> DataFrame:
    """Left rows whose key occurs in ``r`` (``%in%``); left columns only."""
    return l.join(r.select(*_cols(by)), _cols(by), "left_semi")


def embed(df: DataFrame, table: DataFrame, id_col: str, table_id: str | None = None,
          vector: str = "embedding") -> DataFrame:
    """Look up a vector per id. The planner chooses broadcast or sort-merge
    from the table's size (AQE re-checks it at run time)."""
    tid = table_id or id_col
    t = table.select(F.col(tid).alias(id_col), F.col(vector))
    return df.join(t, id_col, "left")


def subset_pairs(sets: DataFrame, id_col: str, items: str, freq: DataFrame | None = None,
                 proper: bool = False) -> DataFrame:
    """Pairs (sub, sup) of rows whose item set ``sub`` lies inside ``sup``.

    Not a nested loop: every candidate ``sub`` is keyed by one of its items
    (its rarest item when item frequencies ``freq(item, n)`` are given, else its
    smallest) and joined to the exploded items of ``sup``; containment is then
    checked with ``array_except``. The pair count is what the output needs, no
    all-pairs product is formed.
    """
    s = sets.select(F.col(id_col).alias("sub_id"), F.col(items).alias("sub_items"))
    if freq is not None:
        ex = s.select("sub_id", F.explode("sub_items").alias("item"))
        ranked = ex.join(freq.select("item", F.col("n").alias("_fn")), "item", "left")
        key = (ranked.groupBy("sub_id")
                     .agg(F.min(F.struct(F.coalesce("_fn", F.lit(0)).alias("f"), "item"))["item"]
                          .alias("key")))
        s = s.join(key, "sub_id")
    else:
        s = s.withColumn("key", F.array_min("sub_items"))
    t = sets.select(F.col(id_col).alias("sup_id"), F.col(items).alias("sup_items"))
    tk = t.select("sup_id", "sup_items", F.explode(F.array_distinct("sup_items")).alias("key"))
    pairs = (s.join(tk, "key")
              .where(F.col("sub_id") != F.col("sup_id"))
              .where(F.size(F.array_except("sub_items", "sup_items")) == 0))
    if proper:
        pairs = pairs.where(F.size(F.array_distinct("sub_items")) < F.size(F.array_distinct("sup_items")))
    return pairs.select("sub_id", "sup_id", "sub_items", "sup_items")


# --- aggregations ----------------------------------------------------------

def n() -> Column:
    """dplyr ``n()``: rows in the group, nulls included."""
    return F.count(F.lit(1))


def strict(agg_fn, c) -> Column:
    """R aggregate without ``na.rm``: null if any input is null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.count(c) == F.count(F.lit(1)), agg_fn(c))


def count_by(df: DataFrame, keys, name: str = "count") -> DataFrame:
    """G1: rows per key (one partial + one final aggregate, one shuffle)."""
    return df.groupBy(*_cols(keys)).agg(n().alias(name))


def rate_by(df: DataFrame, keys, flag: str, name: str = "rate", n_name: str = "n") -> DataFrame:
    """Mean of a 0/1 flag with the row count."""
    return df.groupBy(*_cols(keys)).agg(F.avg(flag).alias(name), n().alias(n_name))


def sum_by(df: DataFrame, keys, measure: str, name: str | None = None) -> DataFrame:
    """Sum per key(s); R ``sum`` without ``na.rm`` (null if any input is null)."""
    return df.groupBy(*_cols(keys)).agg(strict(F.sum, measure).alias(name or f"sum_{measure}"))


def stats(df: DataFrame, cols, na_rm: bool = False, names=None) -> DataFrame:
    """Mean, sd (sample), median (exact, interpolated) per measure, and n().

    With ``na_rm=False`` (R default) a measure containing a null gives nulls.
    Medians come from the distributed exact quantiles (no single-task buffer
    of all values). ``names`` maps a column to its output prefix.
    """
    from kiln.operators.indexing import quantiles
    cols = _cols(cols)
    names = names or {}
    aggs = [n().alias("count")]
    for c in cols:
        aggs += [F.avg(c).alias(f"_{c}_mean"), F.stddev_samp(c).alias(f"_{c}_sd"), F.count(c).alias(f"_{c}_nn")]
    a = df.agg(*aggs)
    med = quantiles(df, cols, [0.5]).groupBy().pivot("column", cols).agg(F.first("value"))
    j = a.crossJoin(F.broadcast(med))
    out = []
    for c in cols:
        pre = names.get(c, c)
        ok = F.lit(True) if na_rm else (F.col(f"_{c}_nn") == F.col("count"))
        out += [F.when(ok, F.col(f"_{c}_mean")).alias(f"{pre}_mean"), F.when(ok, F.col(f"_{c}_sd")).alias(f"{pre}_sd"),
                F.when(ok, F.col(f"`{c}`")).alias(f"{pre}_median")]
    return j.select(*out, "count")


def last_by(df: DataFrame, keys, v: str, order: str, name: str | None = None) -> DataFrame:
    """Value at the last row per key by ``order`` (order-stable ``last``)."""
    return df.groupBy(*_cols(keys)).agg(F.max_by(v, order).alias(name or f"last_{v}"))


def basket_sizes(df: DataFrame, key: str, pos: str, order: str | None = None,
                 name: str = "n_items") -> DataFrame:
    """Distribution of basket sizes, the size being the value of ``pos`` at
    the basket's last row by ``order`` (G5), then counted per size."""
    return count_by(last_by(df, key, pos, order or pos, name=name), name)


def cond_share(df: DataFrame, keys, pred: Column, n_name: str = "n_equal",
               share_name: str = "percent_equal") -> DataFrame:
    """Count of rows meeting ``pred`` (nulls skipped) and its share of n()."""
    return (df.groupBy(*_cols(keys))
              .agg(F.count_if(pred).alias(n_name), n().alias("_n"))
              .withColumn(share_name, F.col(n_name) / F.col("_n")).drop("_n"))


def unit_value(df: DataFrame, keys, value: str, sum_name="SUM_value", count_name="count",
               unit_name="spu") -> DataFrame:
    """Sum and count per key, then the unit value sum/count."""
    return (df.groupBy(*_cols(keys)).agg(F.sum(value).alias(sum_name), n().alias(count_name))
              .withColumn(unit_name, F.col(sum_name) / F.col(count_name)))


def multi_group(df: DataFrame, sets: list[list[str]], measure: str, name: str = "SUM_sales",
                gid: str = "grouping_id") -> DataFrame:
    """One pass computing several groupings (``GROUPING SETS`` via Expand)."""
    keys: list[str] = []
    for s in sets:
        keys += [k for k in s if k not in keys]
    return (df.groupingSets([[F.col(k) for k in s] for s in sets], *keys)
              .agg(F.grouping_id(*keys).alias(gid), F.sum(measure).alias(name)))


def lists_by(df: DataFrame, key, v: str, name: str | None = None, distinct: bool = False) -> DataFrame:
    """Values per key as a sorted list (set with ``distinct``)."""
    agg = F.collect_set(v) if distinct else F.collect_list(v)
    return df.groupBy(*_cols(key)).agg(F.array_sort(agg).alias(name or f"{v}_list"))


def vector_sum(df: DataFrame, key, arr: str, name: str | None = None) -> DataFrame:
    """Element-wise sum of array vectors per key.

    Exploded to (key, position) and summed with map-side partial aggregation, so
    a key holding many rows is combined inside each task before the shuffle;
    each output list has the vector length.
    """
    keys = _cols(key)
    ex = df.select(*keys, F.posexplode(arr).alias("_pos", "_v"))
    s = ex.groupBy(*keys, "_pos").agg(F.sum(F.col("_v").cast("double")).alias("_s"))
    return (s.groupBy(*keys)
             .agg(F.array_sort(F.collect_list(F.struct("_pos", "_s"))).alias("_l"))
             .select(*keys, F.transform("_l", lambda x: x["_s"]).alias(name or f"{arr}_sum")))


# --- shares (windows) --------------------------------------------------------

def share(df: DataFrame, v: str, by=None, name: str = "proportion") -> DataFrame:
    """``v`` over its total, overall or within ``by``.

    The grand total is a one-row aggregate joined back by broadcast (no
    single-partition window); group totals are an aggregate joined on the key.
    """
    if by:
        # group totals by a (partial) hash aggregate joined back on the group
        # key: no window partition holds a whole group
        # (rows without a group are a group)
        tot = df.groupBy(*_cols(by)).agg(F.sum(v).alias("_kiln_tot"))
        return _join(df, tot, by, "left", null_safe=True).select(*df.columns, "_kiln_tot").withColumn(name, F.col(v) / F.col("_kiln_tot")).drop("_kiln_tot")
    tot = df.agg(F.sum(v).alias("_kiln_tot"))
    return df.crossJoin(F.broadcast(tot)).withColumn(name, F.col(v) / F.col("_kiln_tot")).drop("_kiln_tot")


def next_pairs(df: DataFrame, group, pos: str, v: str, name: str | None = None) -> DataFrame:
    """Pair each element with the next one in its group (x[t] -> x[t+1]).

    Positions are dense integers, so ``lead`` is an equi-join on
    (group, pos + 1): rows spread by the hash of both, and one large group does
    not land in a single task as it would in a window partition.
    """
    g = _cols(group)
    nxt = df.select(*g, (F.col(pos) - 1).alias(pos), F.col(v).alias(name or f"next_{v}"))
    return df.join(nxt, [*g, pos], "inner")


def time_split(df: DataFrame, order: str, test_n: int, val_n: int, name: str = "split", tiebreak=()) -> DataFrame:
    """Last ``test_n`` rows are test, the ``val_n`` before them validation,
    the rest train. Only the last ``test_n + val_n`` order values are brought
    together (a bounded top-k); the cut itself is a filter on thresholds. Where
    ``order`` has ties, ``tiebreak`` columns make the cut exact.
    """
    k = test_n + val_n
    at = F.struct(F.col(order), *[F.col(c) for c in _cols(tiebreak)])
    last = (df.select(at.alias("_at")).orderBy(F.col("_at").desc()).limit(k)
              .withColumn("_r", F.row_number().over(Window.orderBy(F.col("_at").desc()))))
    th = last.agg(F.min(F.when(F.col("_r") <= test_n, F.col("_at"))).alias("_t"), F.min("_at").alias("_v"))
    return (df.crossJoin(F.broadcast(th))
              .withColumn(name, F.when(at >= F.col("_t"), "test")
                                 .when(at >= F.col("_v"), "validation")
                                 .otherwise("train"))
              .drop("_t", "_v"))


def number_within(df: DataFrame, key, order, name: str = "row_number", lag: dict | None = None) -> DataFrame:
    """``row_number()`` (1-based, int) and ``lag`` of columns within ``key`` in
    ``order``, proof against one key holding a large share of the rows.

    Rows are range-partitioned on (key, order), which splits a hot key, stored
    once, and numbered by a window inside (partition, key). Only a key that
    continues from one partition into the next needs a correction: the count and
    last row of its parts before, at most two rows for each partition, are
    broadcast. ``lag`` maps a column to the output name of its previous value
    (null on a key's first row). A null key is a key.
    """
    keys, order, lag = _cols(key), _cols(order), lag or {}
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    checkpoint_root(df.sparkSession)
    part = "_kiln_p"
    tagged = df.repartitionByRange(n_parts, *keys, *order).withColumn(part, F.spark_partition_id()).checkpoint(eager=True)

    def same(l, r):
        return reduce(lambda a, b: a & b, [l[k].eqNullSafe(r[f"_kiln_k_{k}"]) for k in keys])
    ends = tagged.groupBy(part).agg(F.min(F.struct(*keys)).alias("lo"), F.max(F.struct(*keys)).alias("hi"))
    either = ends.select(part, F.explode(F.array_distinct(F.array("lo", "hi"))).alias("k"))
    across = (either.groupBy("k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                    .select(*[F.col(f"k.{k}").alias(f"_kiln_k_{k}") for k in keys]))
    pieces = (tagged.join(F.broadcast(across), same(tagged, across), "left_semi").groupBy(part, *keys)
                    .agg(F.count(F.lit(1)).alias("_c"), F.max(F.struct(*order, *[F.col(c).alias(f"_v_{c}") for c in lag])).alias("_last")))
    before = Window.partitionBy(*keys).orderBy(part)
    fixes = pieces.select(F.col(part).alias("_kiln_q"), *[F.col(k).alias(f"_kiln_k_{k}") for k in keys],
                          F.sum("_c").over(before.rowsBetween(Window.unboundedPreceding, -1)).alias("_kiln_add"),
                          F.lag("_last").over(before).alias("_kiln_last"))
    local = Window.partitionBy(part, *keys).orderBy(*order)
    out = tagged.withColumn(name, F.row_number().over(local))
    for c, nm in lag.items():
        out = out.withColumn(nm, F.lag(c).over(local))
    out = out.join(F.broadcast(fixes), (out[part] == fixes["_kiln_q"]) & same(out, fixes), "left")
    for c, nm in lag.items():
        out = out.withColumn(nm, F.when(F.col(name) == 1, F.col(f"_kiln_last._v_{c}")).otherwise(F.col(nm)))
    return (out.withColumn(name, (F.col(name) + F.coalesce("_kiln_add", F.lit(0))).cast("int"))
               .select(*df.columns, name, *lag.values()))


def first_rows(df: DataFrame, n_rows: int, order) -> DataFrame:
    """The first ``n_rows`` in ``order`` (top-k, bounded)."""
    return df.orderBy(*_cols(order)).limit(n_rows)


def fraction_split(df: DataFrame, order, frac: float, name: str = "split") -> DataFrame:
    """First ``floor(n*(1-frac))`` rows by order are train, the rest test.

    The row position comes from the distributed ``row_index``.
    """
    idx = row_index(df, order, name="_pos", start=1)
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    return (idx.crossJoin(F.broadcast(total))
               .withColumn(name, F.when(F.col("_pos") <= F.floor(F.col("_n") * (1 - frac)), "train")
                                  .otherwise("test"))
               .drop("_n"))


def ranked(df: DataFrame, score: str, name: str = "rank", tiebreak=()) -> DataFrame:
    """1-based position by descending score (distributed row numbering)."""
    order = [F.col(score).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak]]
    return row_index(df, order, name=name, start=1)


# --- ordering, top-k, sampling ----------------------------------------------

def arrange(df: DataFrame, *cols: str | Column, desc: tuple[str, ...] = ()) -> DataFrame:
    """Sort with missing values last in both directions."""
    out = []
    for c in cols:
        if isinstance(c, Column):
            out.append(c)
        elif c in desc:
            out.append(F.col(c).desc_nulls_last())
        else:
            out.append(F.col(c).asc_nulls_last())
    return df.orderBy(*out)


def top_n(df: DataFrame, n_rows: int, wt: str) -> DataFrame:
    """Rows whose ``rank()`` by descending ``wt`` is at most ``n_rows`` (ties kept).

    The n-th largest weight is found by a bounded top-k and the table is
    filtered against it - no global window. Missing weights never qualify. The
    top-k keeps all columns, so that both sides are one plan and an aggregate
    below them is computed once.
    """
    row = F.struct(F.col(wt).alias("w"), *[F.col(c) for c in df.columns if c != wt])
    cut = (df.where(F.col(wt).isNotNull()).orderBy(F.col(wt).desc())
             .limit(n_rows).agg(F.min(row)["w"].alias("_cut")))
    return (df.crossJoin(F.broadcast(cut)).where(F.col(wt) >= F.col("_cut")).drop("_cut"))


def sorted_head(df: DataFrame, n_rows: int, *order: str | Column) -> DataFrame:
    """First n rows after sorting (full tie-break is the caller's)."""
    return df.orderBy(*order).limit(n_rows)


def sample_n(df: DataFrame, n_rows: int, seed: int = 0, replace: bool = False,
             key=None, order=None) -> DataFrame:
    """``n_rows`` random rows.

    Without replacement: rows ordered by a seeded hash of ``key`` (default: all
    columns) and the first n kept - a bounded top-k, stable under
    repartitioning. With replacement: n seeded positions, hashes of the draw's
    number, in the order of the table (``rows_at``).
    """
    if not replace:
        k = [F.col(c) for c in (_cols(key) if key else df.columns)]
        return (df.withColumn("_h", hash8(seed, *k))
                  .orderBy("_h", *k).limit(n_rows).drop("_h"))
    cols = [order] if isinstance(order, str) else list(order or df.columns)
    n = df.count()
    draws = (df.sparkSession.range(n_rows if n else 0).withColumnRenamed("id", "draw")
               .withColumn("_pos", F.conv(hash8(seed, "draw"), 16, 10).cast("long") % F.lit(max(n, 1))))
    return draws.join(rows_at(df, cols, draws.select("_pos").distinct(), "_pos"), "_pos").drop("_pos")


def rows_at(df: DataFrame, order: list[str], wanted: DataFrame, pos: str, buckets: int = 2048) -> DataFrame:
    """The rows of ``df`` at the positions ``wanted`` (one column ``pos``, few rows,
    counted from 0 in the order of all of ``order``), with ``pos`` added.

    The table, whose rows must be the same each time it is read, is not sorted. Bounds near the quantiles of the first column deal its
    rows to ``buckets`` ranges, which are counted; only rows of a range that holds a
    wanted position are moved and put in order. A first column that is no number,
    date or time is ordered by the whole (``row_index``).
    """
    kind = df.schema[order[0]].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long", "float", "double", "date", "timestamp", "timestamp_ntz"):
        idx = row_index(df, order, name=pos, start=0)
        return idx.join(wanted, pos)
    first = F.col(order[0])
    if kind == "date":
        value = F.unix_date(first).cast("double")
    elif kind.startswith("timestamp"):
        value = F.unix_micros(first.cast("timestamp")).cast("double")
    else:
        value = first.cast("double")
    probs = F.array(*[F.lit(k / buckets) for k in range(1, buckets)])
    bounds = df.agg(F.percentile_approx(value, probs, 4 * buckets)).first()[0] or []
    # range of a value: how many distinct bounds lie at or below it; nulls come first
    splits = [-math.inf, *(sorted({b for b in bounds if math.isfinite(b)}) or [0.0]), math.inf]
    deal = Bucketizer(splits=splits, inputCol="_value", outputCol="_range", handleInvalid="keep")
    valued = df.withColumn("_value", F.when(~F.isnan(value), value))
    dealt = deal.transform(valued).withColumn("_range", F.when(first.isNull(), -1.0).when(F.col("_value").isNull(), float(len(splits))).otherwise(F.col("_range"))).drop("_value")
    counts = sorted((r["_range"], r["count"]) for r in dealt.groupBy("_range").count().collect())
    start, spans = 0, []
    for bucket, n in counts:  # as many rows as there are ranges
        spans.append((bucket, start, start + n))
        start += n
    spark = df.sparkSession
    table = F.broadcast(spark.createDataFrame(spans, "_range double, _from long, _to long"))
    held = wanted.join(table, (F.col(pos) >= F.col("_from")) & (F.col(pos) < F.col("_to")))
    chosen = [r["_range"] for r in held.select("_range").distinct().collect()]
    before, moved = 0, {}
    for bucket, a, z in spans:
        if bucket in set(chosen):
            moved[bucket] = a - before  # what lies outside the chosen ranges, up to this one
            before += z - a
    if not moved:
        return df.limit(0).withColumn(pos, F.lit(0).cast("long"))
    shift = F.element_at(F.create_map(*[F.lit(x) for b, m in moved.items() for x in (b, m)]), F.col("_range"))
    near = row_index(dealt.where(F.col("_range").isin(chosen)), ["_range", *order], name="_at", start=0)
    return near.withColumn(pos, F.col("_at") + shift).drop("_range", "_at").join(wanted, pos)


# --- set operations ------------------------------------------------------------

def bind_rows(*dfs: DataFrame) -> DataFrame:
    """Stack tables with the same columns; duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def bind_cols(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """Put the columns of two row-aligned tables side by side. Spark has no
    row alignment, so alignment is by a key both tables carry."""
    return left.join(right, _cols(key), "inner")
