"""Projections, scalar and text/date functions (inventory rows F1-F18, F22-F24).

All are native Spark expressions (whole-stage code generation), no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def select_at(df: DataFrame, idx) -> DataFrame:
    """keep columns by 0-based position."""
    return df.select(*[df.columns[i] for i in idx])


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """constant column."""
    return df.withColumn(name, F.lit(value))


def to_number(c, to: str = "double") -> Column:
    """text to number; unparsable text becomes null."""
    return _c(c).try_cast(to)


def factor(df: DataFrame, c: str, name: str | None = None) -> DataFrame:
    """R factor codes 1..k of ``c`` in sorted level order (missing stays
    missing). Levels are numbered on the distinct set with the distributed
    index, then joined back."""
    from kiln.operators.indexing import dense_index
    name = name or f"{c}_level"
    levels = dense_index(df.where(F.col(c).isNotNull()), c, name=name, start=1)
    return df.join(levels, c, "left")


def flag_contains(c, pattern: str, yes: str, no: str) -> Column:
    """F8: case-insensitive regex flag with two labels; null stays null."""
    col = _c(c)
    return F.when(col.rlike(f"(?i){pattern}"), F.lit(yes)).when(col.isNotNull(), F.lit(no))


def hash8(seed, *cols) -> Column:
    """Eight hex digits of an md5 of a seed and the columns as text: a seeded draw
    that any engine with md5 reproduces, whatever the partitioning."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[_c(c).cast("string") for c in cols])), 1, 8)


def paste0(*cols) -> Column:
    """R ``paste0``: concatenation where a missing value prints as "NA"."""
    return F.concat(*[F.coalesce(_c(c).cast("string"), F.lit("NA")) for c in cols])


def split_by(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """rows meeting ``pred`` and rows failing it; null predicates go to neither."""
    return df.where(pred), df.where(~pred)


def strip_chars(c, chars: str = '{}"') -> Column:
    """remove every listed character."""
    return F.translate(_c(c), chars, "")


def split_wide(df: DataFrame, c: str, sep: str, n: int, prefix: str | None = None,
               trim: bool = True) -> DataFrame:
    """split text into ``prefix_1..prefix_n`` columns; short rows get nulls.

    ``sep`` is a literal separator.
    """
    import re
    parts = F.split(_c(c), re.escape(sep))
    p = prefix or c
    out = []
    for i in range(1, n + 1):
        e = F.try_element_at(parts, F.lit(i))
        e = F.trim(e) if trim else e
        out.append(F.when(e != "", e).alias(f"{p}_{i}") if trim else e.alias(f"{p}_{i}"))
    return df.select("*", *out)


#: Year, month, day in the forms that ``ymd`` takes.
YMD = ("yyyy-M-d", "yyyy/M/d", "yyyy.M.d", "yyyy M d", "yyyyMMdd")


def parse_date(c, formats=YMD) -> Column:
    """text to date by the first of ``formats`` that fits (null if none does)."""
    formats = [formats] if isinstance(formats, str) else formats
    return F.coalesce(*[F.try_to_timestamp(F.trim(_c(c)), F.lit(f)) for f in formats]).cast("date")


def date_labels(c) -> Column:
    """F16: "Mon dd" axis label of a date/time."""
    return F.date_format(_c(c), "MMM dd")


def every_nth_label(df: DataFrame, c: str, start: int = 12, step: int = 24, name: str = "label") -> DataFrame:
    """F16: "Mon dd" labels of every ``step``-th row from position ``start``
    (0-based) in ``c`` order; positions from the distributed row index."""
    from kiln.operators.indexing import row_index
    idx = row_index(df.select(c), c, name="_pos", start=0)
    return (idx.where((F.col("_pos") >= start) & ((F.col("_pos") - start) % step == 0))
               .select(c, date_labels(c).alias(name)))


def fmt2(c, decimals: int = 2) -> Column:
    """Number as text with ``decimals`` places, rounded half up.

    Rounding is done on ``x * 10^d`` in double arithmetic and the text is built
    from the integer, so the result does not depend on a printf implementation.
    """
    col = _c(c).cast("double")
    scale = 10 ** decimals
    units = F.floor(F.abs(col) * scale + F.lit(0.5)).cast("long")
    whole = (units / scale).cast("long").cast("string")
    frac = F.lpad((units % scale).cast("string"), decimals, "0")
    sign = F.when((col < 0) & (units > 0), F.lit("-")).otherwise(F.lit(""))
    txt = F.concat(sign, whole, F.lit("."), frac) if decimals else F.concat(sign, whole)
    return F.when(col.isNotNull(), txt)


def sigmoid(c) -> Column:
    """logistic function."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(c)))


def dummies(df: DataFrame, cols, drop: bool = True, max_levels: int = 1000) -> DataFrame:
    """one-hot columns ``<col>_<value>`` in value order (pandas ``get_dummies``).

    The levels are found by one distinct job (no column may have more than
    ``max_levels``, since each becomes a column); then a single projection adds
    the indicator columns. Missing values give all zeros. For wide domains use
    ``pyspark.ml.feature.OneHotEncoder`` (sparse vectors) instead.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    lv = (df.select(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v"))
                               for c in cols]).alias("a"))
            .select(F.explode("a").alias("kv")).select("kv.k", "kv.v")
            .where(F.col("v").isNotNull()).distinct())
    wide = [r.k for r in lv.groupBy("k").count().where(F.col("count") > max_levels).collect()]
    if wide:
        raise ValueError(f"too many levels for one-hot columns in {', '.join(sorted(wide))}; use OneHotEncoder")
    levels = lv.collect()
    by_col: dict[str, list] = {c: [] for c in cols}
    for r in levels:
        by_col[r.k].append(r.v)
    types = dict(df.dtypes)
    new = []
    for c in cols:
        vals = by_col[c]
        numeric = types[c] in ("int", "bigint", "smallint", "tinyint", "double", "float")
        vals = sorted(vals, key=(lambda v: float(v)) if numeric else None)
        for v in vals:
            new.append(F.when(F.col(c).cast("string") == v, 1).otherwise(0).alias(f"{c}_{v}"))
    keep = [c for c in df.columns if not (drop and c in cols)]
    return df.select(*keep, *new)


def standardize(df: DataFrame, cols, suffix: str = "") -> tuple[DataFrame, DataFrame]:
    """z-scores with the sample sd; returns (table, one-row stats table).

    The stats row is a global aggregate broadcast back (one row).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    st = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"{c}__mean"),
                                              F.stddev_samp(c).alias(f"{c}__sd"))])
    j = df.crossJoin(F.broadcast(st))
    def z(c):  # a column without spread gives nulls, not a divide-by-zero error
        return F.try_divide(F.col(c) - F.col(f"{c}__mean"), F.col(f"{c}__sd"))
    out = j.select(*[z(c).alias(c + suffix) if c in cols and not suffix else F.col(c) for c in df.columns],
                   *[z(c).alias(c + suffix) for c in cols if suffix])
    return out, st


def unstandardize(df: DataFrame, c: str, stats: DataFrame, source: str | None = None) -> DataFrame:
    """back from z-score: ``z * sd + mean`` using the stats of ``source``."""
    s = source or c
    st = stats.select(F.col(f"{s}__mean").alias("_m"), F.col(f"{s}__sd").alias("_s"))
    return (df.crossJoin(F.broadcast(st))
              .withColumn(c, F.col(c) * F.col("_s") + F.col("_m")).drop("_m", "_s"))
