"""Data profiling (P1-P10): schema, summaries, skim, histograms, correlations.

Each summary is one aggregate pass over the data, then reshaped to long form
with ``inline`` (rows of structs), so the result is a small table.
Exact quantiles interpolate linearly, as R and pandas do; ``exact=False`` ranks by
KLL sketches instead, for columns of very many values.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.indexing import quantiles
from kiln.operators.relational import first_rows

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")
KLL_K = 2000  # size of the sketches that rank numbers: rank errors of about 0.2 %
WS_CLASS = "[ \\t\\n\\x0B\\f\\r]"


def head(df: DataFrame, n: int = 5, order=None) -> DataFrame:
    """First n rows; with ``order`` deterministic (bounded top-k)."""
    return first_rows(df, n, order) if order is not None else df.limit(n)


def describe_schema(df: DataFrame) -> DataFrame:
    """(position, column, type, non_null) - one counting pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type"),
                     F.col(f"c{i}").alias("non_null"))
            for i, (c, t) in enumerate(df.dtypes)]
    return counts.select(F.inline(F.array(*rows)))


def summary6(df: DataFrame, cols, exact: bool = True) -> DataFrame:
    """Min, q1, median, mean, q3, max per column (R ``summary``), long form.

    Quartiles come from the distributed exact ``quantiles`` (or from sketches
    with ``exact=False``); min/max/mean from one aggregate.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    base = _melt(df, cols).groupBy("column").agg(F.min("value").alias("min"), F.max("value").alias("max"),
                                                  F.avg("value").alias("mean"))
    q = _quartiles(df, cols, [0.25, 0.5, 0.75], exact)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string").coalesce(1)
    return (names.join(base, "column", "left").join(q, "column", "left")
                 .select("column", "min", F.col("q25").alias("q1"), F.col("q50").alias("median"), "mean",
                         F.col("q75").alias("q3"), "max"))


def _quartiles(df: DataFrame, cols, probs, exact: bool) -> DataFrame:
    """(column, q<100p>...) wide table of quantiles per column."""
    names = [f"q{int(round(p * 100))}" for p in probs]
    if exact:
        q = quantiles(df, cols, probs)
        return q.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(nm)
                                         for p, nm in zip(probs, names)])
    m = _melt(df, cols).where("value IS NOT NULL").groupBy("column").agg(
        F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double("value", F.lit(KLL_K)), F.array(*[F.lit(float(p)) for p in probs])).alias("_q"))
    return m.select("column", *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)])


def _text_counts(df: DataFrame, cols) -> DataFrame:
    """(column, value, n): how often each text column holds each value, nulls left out."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in cols])
    return df.select(F.inline(each)).where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def skim(df: DataFrame, exact: bool = True, approx_distinct: bool = False) -> DataFrame:
    """Skimr-style profile, one row per column.

    Text columns: n_missing, complete_rate, min/max length, empty, n_unique,
    whitespace. Numeric: n_missing, complete_rate, mean, sd, p0..p100. All but text
    is one aggregate. What is told of text follows from one relation of counted
    values, so that a frequent value is one row and is measured once. With
    ``exact=False`` sketches count distinct values (HyperLogLog, 2 % standard error)
    and rank numbers (KLL, some 0.2 % of the rows); ``approx_distinct`` has the first only.
    """
    texts = [c for c, t in df.dtypes if t == "string"]
    numeric = [c for c, t in df.dtypes if t in NUMERIC]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, (c, t) in enumerate(df.dtypes):
        col = F.col(f"`{c}`")
        aggs.append(F.count(col).alias(f"nn{i}"))
        if t in NUMERIC:
            aggs += [F.avg(col.cast("double")).alias(f"av{i}"), F.stddev_samp(col.cast("double")).alias(f"sd{i}")]
        elif t == "string" and (approx_distinct or not exact):
            aggs.append(F.hll_sketch_estimate(F.hll_sketch_agg(col)).alias(f"un{i}"))
    rows = []
    for i, (c, t) in enumerate(df.dtypes):
        kind = "character" if t == "string" else "numeric" if t in NUMERIC else "other"
        known = {"mean": F.col(f"av{i}"), "sd": F.col(f"sd{i}")} if kind == "numeric" else {}
        if kind == "character" and (approx_distinct or not exact):
            known["_unique"] = F.col(f"un{i}")
        rows.append(F.struct(F.lit(c).alias("skim_variable"), F.lit(kind).alias("skim_type"), (F.col("_n") - F.col(f"nn{i}")).alias("n_missing"),
                             F.try_divide(F.col(f"nn{i}"), F.col("_n")).alias("complete_rate"),
                             known.get("_unique", F.lit(None)).cast("bigint").alias("_unique"),
                             *[known.get(k, F.lit(None).cast("double")).alias(k) for k in ("mean", "sd")]))
    out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    null_l = F.lit(None).cast("bigint")
    if texts:
        size = F.length("value").cast("bigint")
        told = _text_counts(df, texts).groupBy("column").agg(
            F.min(size).alias("min_len"), F.max(size).alias("max_len"), F.sum(F.when(F.col("value") == "", F.col("n")).otherwise(0)).alias("empty"),
            F.count(F.lit(1)).alias("_values"), F.sum(F.when(F.col("value").rlike(f"^{WS_CLASS}+$"), F.col("n")).otherwise(0)).alias("whitespace"))
        out = out.join(told.withColumnRenamed("column", "skim_variable"), "skim_variable", "left")
        is_text = F.col("skim_type") == "character"
        for c in ("empty", "whitespace"):
            out = out.withColumn(c, F.when(is_text, F.coalesce(c, F.lit(0))))
        out = out.withColumn("n_unique", F.when(is_text, F.coalesce("_unique", "_values", F.lit(0))))
    else:
        out = out.select("*", *[null_l.alias(c) for c in ("min_len", "max_len", "empty", "n_unique", "whitespace")])
    pcols = ["p0", "p25", "p50", "p75", "p100"]
    if numeric:
        q = _quartiles(df, numeric, [0.0, 0.25, 0.5, 0.75, 1.0], exact).withColumnRenamed("column", "skim_variable")
        out = out.join(q, "skim_variable", "left").withColumnsRenamed({f"q{k}": p for k, p in zip((0, 25, 50, 75, 100), pcols)})
    else:
        out = out.select("*", *[F.lit(None).cast("double").alias(p) for p in pcols])
    return out.select("skim_variable", "skim_type", "n_missing", "complete_rate", "min_len", "max_len", "empty", "n_unique", "whitespace",
                      "mean", "sd", *pcols)


def sketches(df: DataFrame, by: list[str]) -> DataFrame:
    """Mergeable sketches of each part of a table (its partitions, days, files):
    (by..., column, n, distinct, ranks), one row for each part and column. Kept
    next to the table, they profile any union of parts without reading it again."""
    kept = [(c, t) for c, t in df.dtypes if c not in by and (t == "string" or t in NUMERIC)]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"d{i}").alias("distinct"),
                     (F.col(f"r{i}") if t != "string" else F.lit(None).cast("binary")).alias("ranks")) for i, (c, t) in enumerate(kept)]
    aggs = []
    for i, (c, t) in enumerate(kept):
        col = F.col(f"`{c}`")
        aggs += [F.count(col).alias(f"n{i}"), F.hll_sketch_agg(col if t == "string" else col.cast("double").cast("string")).alias(f"d{i}")]
        if t != "string":
            aggs.append(F.kll_sketch_agg_double(col.cast("double"), F.lit(KLL_K)).alias(f"r{i}"))
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*rows)))


def profile_of(sketched: DataFrame, probs=(0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """(column, n, n_unique, quantiles) of all parts together, from their sketches;
    quantiles are null for text."""
    merged = sketched.groupBy("column").agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_unique"),
                                            F.kll_merge_agg_double("ranks").alias("_r"), F.max(F.col("ranks").isNotNull()).alias("_num"))
    found = F.kll_sketch_get_quantile_double("_r", F.array(*[F.lit(float(p)) for p in probs]))
    return merged.select("column", "n", "n_unique", F.when(F.col("_num") & (F.col("n") > 0), found).alias("quantiles"))


def _melt(df: DataFrame, cols) -> DataFrame:
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"),
                                                 F.col(c).cast("double").alias("value")) for c in cols])))


def histograms(df: DataFrame, cols, bins: int = 10) -> DataFrame:
    """P5: equal-width histogram per numeric column, last bin closed; empty bins
    are kept with n = 0. Per-column (min, max) is one small aggregate."""
    m = _melt(df, cols).where(F.col("value").isNotNull())
    st = m.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = F.col("hi") - F.col("lo")
    binned = (m.join(F.broadcast(st), "column")
                .withColumn("bin", F.when(width == 0, F.lit(0)).otherwise(
                    F.least(F.floor((F.col("value") - F.col("lo")) / width * bins), F.lit(bins - 1))).cast("int"))
                .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n")))
    grid = st.select("column", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(binned, ["column", "bin"], "left")
                .select("column", "bin",
                        F.round(F.col("lo") + F.col("bin") * width / bins, 6).alias("bin_lo"),
                        F.round(F.col("lo") + (F.col("bin") + 1) * width / bins, 6).alias("bin_hi"),
                        F.coalesce("n", F.lit(0)).alias("n")))


# A step is 1, 2, 5 or 10 times a power of ten; each serves up to
# this ratio of the wanted width to the power.
_STEPS = ((1, 1.4), (2, 2.8), (5, 7.0), (10, math.inf))


def pretty_breaks(lo: float, hi: float, n: int = 5) -> list[float]:
    """R ``pretty``: about n + 1 equally spaced round values that cover [lo, hi].
    A range without width gets one step around its value."""
    size = max(abs(lo), abs(hi)) or 1.0
    narrow = hi - lo < 1e-14 * size
    width = 0.75 * (size if size <= 10 else 9 + size / 10) if narrow else (hi - lo) / max(1, n)
    power = 10.0 ** math.floor(math.log10(width))
    step = power * next(u for u, most in _STEPS if width / power <= most)
    first, last = math.floor(lo / step + 1e-10), math.ceil(hi / step - 1e-10)
    return [round(i * step, 12) for i in range(first, max(last, first + 1) + 1)]


def hist_pretty(df: DataFrame, c: str) -> DataFrame:
    """R ``hist`` counts: Sturges class count, ``pretty`` breaks, bins
    closed on the right with the lowest break included.

    Only (n, min, max) reach the driver; the bin of a value follows by
    arithmetic, since the breaks are equally spaced, and one grouped count.
    """
    st = df.agg(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    if not st or st.n == 0:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    brks = pretty_breaks(float(st.lo), float(st.hi), math.ceil(math.log2(st.n) + 1))
    step = brks[1] - brks[0]
    # R's hist widens the breaks by a small fuzz
    at = F.ceil((F.col(c).cast("double") - brks[0]) / step - 1e-7)
    idx = F.greatest(F.lit(1), F.least(F.lit(len(brks) - 1), at))
    counted = (df.where(F.col(c).isNotNull()).select(idx.cast("int").alias("bin"))
                 .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    grid = df.sparkSession.createDataFrame(
        [(i, float(brks[i - 1]), float(brks[i])) for i in range(1, len(brks))],
        "bin int, lower double, upper double")
    return grid.join(counted, "bin", "left").select("bin", "lower", "upper",
                                                     F.coalesce("n", F.lit(0)).alias("n"))


def _corr(a, b):
    """Pearson correlation over rows where both are present; NaN when either
    side has no spread (as pandas), instead of Spark's divide-by-zero error
    under ANSI mode."""
    a2 = F.when(b.isNotNull(), a)
    b2 = F.when(a.isNotNull(), b)
    den = F.stddev_pop(a2) * F.stddev_pop(b2)
    return F.when(den == 0, F.lit(float("nan"))).otherwise(F.try_divide(F.covar_pop(a2, b2), den))


def corr_matrix(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """Pearson correlation of every ordered pair (pairwise-complete rows),
    long form (col_i, col_j, i, j, corr), from one aggregate."""
    aggs, rows = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j <= i:
                aggs.append(_corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}_{j}"))
    g = df.agg(*aggs)
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            key = f"r{i}_{j}" if j <= i else f"r{j}_{i}"
            rows.append(F.struct(F.lit(a).alias("col_i"), F.lit(b).alias("col_j"), F.lit(i).alias("i"),
                                 F.lit(j).alias("j"), F.round(F.col(key), digits).alias("corr")))
    return g.select(F.inline(F.array(*rows)))


def corr_lower(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    """Lower triangle of the correlation matrix, diagonal kept."""
    return corr_matrix(df, cols, digits).where(F.col("i") >= F.col("j"))


def freq(df: DataFrame, c: str, name: str = "n") -> DataFrame:
    """Frequency of each value (missing is its own value)."""
    return df.groupBy(c).agg(F.count(F.lit(1)).alias(name))


def missing(df: DataFrame, c: str, keep: str = "missing") -> DataFrame:
    """P10: rows where ``c`` is missing (``keep='missing'``) or present."""
    return df.where(F.col(c).isNull() if keep == "missing" else F.col(c).isNotNull())
