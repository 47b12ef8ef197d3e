"""Profiling queries (P1-P10) over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import profile as P
from kiln.operators import relational as R
from kiln.plans.registry import query
from kiln.sources.tables import Tables
from kiln.sources.views import views

HOURLY_NUM = ["cnt", "temp", "hum", "windspeed", "weathersit", "hr"]
CUSTOMER_COLS = [("c_custkey", "numeric"), ("c_name", "character"), ("c_nationkey", "numeric"),
                 ("c_acctbal", "numeric"), ("c_mktsegment", "character")]
LINEITEM_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                  ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                  ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                  ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


@query("p1_head", "SELECT * FROM hourly ORDER BY ts_hour LIMIT 5")
def p1_head(spark, sf_dir, n=5):
    return P.head(views(spark, sf_dir).hourly, n, "ts_hour")


def _describe_sql():
    counts = ", ".join(f"COUNT({c}) AS c{i}" for i, (c, _) in enumerate(LINEITEM_TYPES))
    parts = [f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, c{i} AS non_null FROM cnt"
             for i, (c, t) in enumerate(LINEITEM_TYPES)]
    return f"WITH cnt AS (SELECT {counts} FROM lineitem)\n" + "\nUNION ALL ".join(parts)


@query("p2_describe_schema", _describe_sql())
def p2_describe_schema(spark, sf_dir):
    return P.describe_schema(Tables(spark, sf_dir).lineitem)


@query("p3_summary6", """
SELECT 'l_quantity' AS "column", MIN(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS q1,
       quantile_cont(l_quantity, 0.5) AS median, AVG(l_quantity) AS mean, quantile_cont(l_quantity, 0.75) AS q3,
       MAX(l_quantity) AS max FROM lineitem
UNION ALL
SELECT 'l_extendedprice', MIN(l_extendedprice), quantile_cont(l_extendedprice, 0.25), quantile_cont(l_extendedprice, 0.5),
       AVG(l_extendedprice), quantile_cont(l_extendedprice, 0.75), MAX(l_extendedprice) FROM lineitem
UNION ALL
SELECT 'l_discount', MIN(l_discount), quantile_cont(l_discount, 0.25), quantile_cont(l_discount, 0.5),
       AVG(l_discount), quantile_cont(l_discount, 0.75), MAX(l_discount) FROM lineitem
""")
def p3_summary6(spark, sf_dir):
    return P.summary6(Tables(spark, sf_dir).lineitem, ["l_quantity", "l_extendedprice", "l_discount"])


def _skim_sql():
    ws = "'^[ \\t\\n\\x0B\\f\\r]+$'"
    parts = []
    for c, kind in CUSTOMER_COLS:
        head = (f"SELECT '{c}' AS skim_variable, '{kind}' AS skim_type, COUNT(*) - COUNT({c}) AS n_missing, "
                f"COUNT({c}) / COUNT(*) AS complete_rate, ")
        if kind == "character":
            body = (f"CAST(MIN(length({c})) AS BIGINT) AS min_len, CAST(MAX(length({c})) AS BIGINT) AS max_len, "
                    f"COUNT(*) FILTER (WHERE {c} = '') AS empty, COUNT(DISTINCT {c}) AS n_unique, "
                    f"COUNT(*) FILTER (WHERE regexp_matches({c}, {ws})) AS whitespace, "
                    "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS sd, CAST(NULL AS DOUBLE) AS p0, "
                    "CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75, "
                    "CAST(NULL AS DOUBLE) AS p100")
        else:
            x = f"CAST({c} AS DOUBLE)"
            body = ("CAST(NULL AS BIGINT) AS min_len, CAST(NULL AS BIGINT) AS max_len, CAST(NULL AS BIGINT) AS empty, "
                    "CAST(NULL AS BIGINT) AS n_unique, CAST(NULL AS BIGINT) AS whitespace, "
                    f"AVG({x}) AS mean, STDDEV_SAMP({x}) AS sd, quantile_cont({x}, 0.0) AS p0, "
                    f"quantile_cont({x}, 0.25) AS p25, quantile_cont({x}, 0.5) AS p50, "
                    f"quantile_cont({x}, 0.75) AS p75, quantile_cont({x}, 1.0) AS p100")
        parts.append(head + body + " FROM customer")
    return "\nUNION ALL ".join(parts)


@query("p4_skim", _skim_sql())
def p4_skim(spark, sf_dir):
    return P.skim(Tables(spark, sf_dir).customer)


def _hist_sql(cols, bins=10):
    melt = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM hourly" for c in cols)
    return f"""
WITH m AS ({melt}),
s AS (SELECT "column", MIN(value) AS lo, MAX(value) AS hi FROM m WHERE value IS NOT NULL GROUP BY "column"),
c AS (SELECT m."column", CAST(CASE WHEN s.hi = s.lo THEN 0 ELSE LEAST(FLOOR((m.value - s.lo) / (s.hi - s.lo) * {bins}), {bins - 1}) END AS INTEGER) AS bin,
             COUNT(*) AS n
      FROM m JOIN s ON m."column" = s."column" WHERE m.value IS NOT NULL GROUP BY 1, 2),
g AS (SELECT s."column", s.lo, s.hi, CAST(b.range AS INTEGER) AS bin FROM s CROSS JOIN range({bins}) b)
SELECT g."column", g.bin, ROUND(g.lo + g.bin * (g.hi - g.lo) / {bins}, 6) AS bin_lo,
       ROUND(g.lo + (g.bin + 1) * (g.hi - g.lo) / {bins}, 6) AS bin_hi, COALESCE(c.n, 0) AS n
FROM g LEFT JOIN c ON g."column" = c."column" AND g.bin = c.bin
"""


@query("p5_histograms", _hist_sql(HOURLY_NUM))
def p5_histograms(spark, sf_dir, bins=10):
    return P.histograms(views(spark, sf_dir).hourly, HOURLY_NUM, bins)


def _pretty_sql(where="TRUE"):
    """The break rule for one subset of the counts: the step is 1, 2, 5 or 10 times a power of ten."""
    return f"""(WITH v AS (SELECT "count"::DOUBLE AS c FROM uc WHERE {where}),
s AS (SELECT count(*) AS n, min(c) AS lo, max(c) AS hi, ceil(log2(count(*)) + 1) AS k, greatest(abs(min(c)), abs(max(c))) AS size FROM v),
w AS (SELECT *, CASE WHEN hi - lo < 1e-14 * size THEN 0.75 * CASE WHEN size <= 10 THEN size ELSE 9 + size / 10 END ELSE (hi - lo) / k END AS width FROM s WHERE n > 0),
p AS (SELECT *, 10.0 ** floor(log10(width)) AS power FROM w),
t AS (SELECT *, power * CASE WHEN width / power <= 1.4 THEN 1 WHEN width / power <= 2.8 THEN 2 WHEN width / power <= 7 THEN 5 ELSE 10 END AS step FROM p),
b AS (SELECT *, floor(lo / step + 1e-10)::BIGINT AS a, ceil(hi / step - 1e-10)::BIGINT AS z FROM t),
g AS (SELECT lo, step, a, greatest(z, a + 1) - a AS bins, unnest(range(1, greatest(z, a + 1) - a + 1)) AS bin FROM b),
h AS (SELECT greatest(1, least(bins, ceil((c - a * step) / step - 1e-7)))::BIGINT AS bin, count(*) AS n FROM v, (SELECT DISTINCT a, step, bins FROM g) GROUP BY 1)
SELECT bin::INTEGER AS bin, ((a + bin - 1) * step)::DOUBLE AS lower, ((a + bin) * step)::DOUBLE AS upper, coalesce(n, 0)::BIGINT AS n FROM g LEFT JOIN h USING (bin))"""


@query("p6_hist_pretty", f"""
WITH uc AS (SELECT customer_id, count(*) AS "count" FROM receipt LEFT JOIN shopper USING (customer_id) GROUP BY customer_id)
SELECT *, 'all' AS subset FROM {_pretty_sql()} UNION ALL SELECT *, 'below_100' AS subset FROM {_pretty_sql('"count" < 100')}
""")
def p6_hist_pretty(spark, sf_dir):
    """Visits per customer: histogram of all counts and of counts below 100."""
    v = views(spark, sf_dir)
    uc = R.count_by(R.natural_left_join(v.receipt, v.shopper), "customer_id")
    return R.bind_rows(P.hist_pretty(uc, "count").withColumn("subset", F.lit("all")),
                       P.hist_pretty(uc.where(F.col("count") < 100), "count").withColumn("subset", F.lit("below_100")))


def _corr_sql(cols, lower=False):
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if lower and i < j:
                continue
            parts.append(f"SELECT '{a}' AS col_i, '{b}' AS col_j, {i} AS i, {j} AS j, "
                         f"ROUND(CORR(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM hourly")
    return "\nUNION ALL ".join(parts)


@query("p7_corr_matrix", _corr_sql(HOURLY_NUM))
def p7_corr_matrix(spark, sf_dir):
    return P.corr_matrix(views(spark, sf_dir).hourly, HOURLY_NUM)


@query("p8_corr_lower", _corr_sql(HOURLY_NUM, lower=True))
def p8_corr_lower(spark, sf_dir):
    return P.corr_lower(views(spark, sf_dir).hourly, HOURLY_NUM)


@query("p9_freq", """
SELECT days_since_prior_order, COUNT(*) AS n FROM shop_orders GROUP BY days_since_prior_order
""")
def p9_freq(spark, sf_dir):
    return P.freq(views(spark, sf_dir).shop_orders, "days_since_prior_order")


@query("p10_missing", "SELECT * FROM shop_orders WHERE days_since_prior_order IS NULL")
def p10_missing(spark, sf_dir):
    return P.missing(views(spark, sf_dir).shop_orders, "days_since_prior_order", keep="missing")
