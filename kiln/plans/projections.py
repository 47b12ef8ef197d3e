"""Projection, filter and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import columns as C
from kiln.operators import relational as R
from kiln.plans.registry import query
from kiln.sources.tables import Tables
from kiln.sources.views import views


@query("f1_select", "SELECT order_id, product_id FROM order_products")
def f1_select(spark, sf_dir):
    return views(spark, sf_dir).order_products.select("order_id", "product_id")


@query("f2_select_at", "SELECT product_name, department FROM products")
def f2_select_at(spark, sf_dir):
    return C.select_at(views(spark, sf_dir).products, [1, 3])


@query("f3_drop", "SELECT log_month, customer_id, pos_large_class_name, amount FROM receipt")
def f3_drop(spark, sf_dir):
    return views(spark, sf_dir).receipt.drop("item", "sales")


@query("f4_with_value", """
SELECT customer_id, item, amount, CAST(sales AS DOUBLE) AS sales, CAST(amount * sales AS DOUBLE) AS value FROM receipt
""")
def f4_with_value(spark, sf_dir):
    r = views(spark, sf_dir).receipt
    return r.select("customer_id", "item", "amount", F.col("sales").cast("double").alias("sales"),
                    (F.col("amount") * F.col("sales")).cast("double").alias("value"))


@query("f5_tag", "SELECT *, 'part' AS source FROM products")
def f5_tag(spark, sf_dir):
    return C.tag(views(spark, sf_dir).products, "source", "part")


@query("f6_to_number", """
SELECT p_partkey, p_brand, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no,
       TRY_CAST(p_type AS INTEGER) AS type_no FROM part
""")
def f6_to_number(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey", "p_brand",
                    C.to_number(F.try_element_at(F.split("p_brand", "#"), F.lit(2)), "int").alias("brand_no"),
                    C.to_number("p_type", "int").alias("type_no"))


@query("f7_factor", """
SELECT product_id, department, DENSE_RANK() OVER (ORDER BY department) AS department_level FROM products
""")
def f7_factor(spark, sf_dir):
    """Factor codes 1..k in sorted level order. Levels are numbered on the
    distinct set with the distributed index, then joined back."""
    p = views(spark, sf_dir).products.select("product_id", "department")
    return C.factor(p, "department", "department_level").select("product_id", "department", "department_level")


@query("f8_flag_contains", """
SELECT product_id, product_name, CASE WHEN regexp_matches(lower(product_name), 'red') THEN 'red'
                                      WHEN product_name IS NOT NULL THEN 'not red' END AS red
FROM products
""")
def f8_flag_contains(spark, sf_dir, pattern="red"):
    p = views(spark, sf_dir).products
    return p.select("product_id", "product_name",
                    C.flag_contains("product_name", pattern, pattern, f"not {pattern}").alias(pattern))


@query("f9_paste0", """
SELECT customer_id, concat(coalesce(gender, 'NA'), coalesce(CAST(generation AS VARCHAR), 'NA'),
                           coalesce(CAST(NULLIF(occupation, 'HOUSEHOLD') AS VARCHAR), 'NA')) AS gen_gene
FROM shopper
""")
def f9_paste0(spark, sf_dir):
    s = views(spark, sf_dir).shopper
    occ = F.when(F.col("occupation") != "HOUSEHOLD", F.col("occupation"))
    return s.select("customer_id", C.paste0("gender", "generation", occ).alias("gen_gene"))


@query("f10_filter", "SELECT * FROM order_products WHERE reordered = 1 AND add_to_cart_order <= 3")
def f10_filter(spark, sf_dir):
    o = views(spark, sf_dir).order_products
    return o.where((F.col("reordered") == 1) & (F.col("add_to_cart_order") <= 3))


@query("f11_split_by", """
SELECT customer_id, count, CASE WHEN count < 20 THEN 'under' ELSE 'from' END AS side
FROM (SELECT customer_id, COUNT(*) AS count FROM receipt GROUP BY customer_id)
""")
def f11_split_by(spark, sf_dir, threshold=20):
    uc = R.count_by(views(spark, sf_dir).receipt, "customer_id")
    under, over = C.split_by(uc, F.col("count") < threshold)
    return R.bind_rows(C.tag(under, "side", "under"), C.tag(over, "side", "from"))


@query("f12_strip_chars", """
SELECT event_id, props, regexp_replace(props, '[{}"]', '', 'g') AS props_clean FROM events
""")
def f12_strip_chars(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.select("event_id", "props", C.strip_chars("props", '{}"').alias("props_clean"))


@query("f13_split_wide", """
SELECT product_id, product_name,
       NULLIF(trim(split_part(product_name, ' ', 1)), '') AS name_1,
       NULLIF(trim(split_part(product_name, ' ', 2)), '') AS name_2,
       NULLIF(trim(split_part(product_name, ' ', 3)), '') AS name_3
FROM products
""")
def f13_split_wide(spark, sf_dir):
    p = views(spark, sf_dir).products.select("product_id", "product_name")
    return C.split_wide(p, "product_name", " ", 3, prefix="name")


@query("f14_rename", "SELECT product_id, product_name AS name, aisle, department FROM products")
def f14_rename(spark, sf_dir):
    return views(spark, sf_dir).products.withColumnsRenamed({"product_name": "name"})


@query("f15_to_date", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
            ELSE strftime(o_orderdate, '%Y%m%d') END AS day_text,
       CAST(o_orderdate AS DATE) AS order_date FROM orders
""")
def f15_to_date(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    form = F.col("o_orderkey") % 3
    txt = (F.when(form == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(form == 1, F.date_format("o_orderdate", "yyyy/MM/dd"))
            .otherwise(F.date_format("o_orderdate", "yyyyMMdd")))
    return o.select("o_orderkey", txt.alias("day_text"), C.parse_date(txt).alias("order_date"))


@query("f16_date_labels", """
SELECT ts_hour, strftime(ts_hour, '%b %d') AS label
FROM (SELECT ts_hour, ROW_NUMBER() OVER (ORDER BY ts_hour) - 1 AS pos FROM hourly)
WHERE pos >= 12 AND (pos - 12) % 24 = 0
""")
def f16_date_labels(spark, sf_dir, start=12, step=24):
    return C.every_nth_label(views(spark, sf_dir).hourly, "ts_hour", start, step)


def _fmt2_sql(x):
    u = f"CAST(FLOOR(ABS(CAST({x} AS DOUBLE)) * 100 + 0.5) AS BIGINT)"
    return (f"CASE WHEN {x} IS NOT NULL THEN concat(CASE WHEN CAST({x} AS DOUBLE) < 0 AND {u} > 0 THEN '-' ELSE '' END, "
            f"CAST({u} // 100 AS VARCHAR), '.', lpad(CAST({u} % 100 AS VARCHAR), 2, '0')) END")


@query("f17_fmt2", f"""
SELECT l_returnflag, {_fmt2_sql('revenue')} AS revenue, {_fmt2_sql('avg_qty')} AS avg_qty,
       {_fmt2_sql('avg_disc')} AS avg_disc
FROM (SELECT l_returnflag, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue, AVG(l_quantity) AS avg_qty,
             AVG(l_discount) - 0.05 AS avg_disc FROM lineitem GROUP BY l_returnflag)
""")
def f17_fmt2(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    g = li.groupBy("l_returnflag").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue"),
                                       F.avg("l_quantity").alias("avg_qty"),
                                       (F.avg("l_discount") - F.lit(0.05)).alias("avg_disc"))
    return g.select("l_returnflag", *[C.fmt2(c).alias(c) for c in ("revenue", "avg_qty", "avg_disc")])


@query("f18_math", """
SELECT ts_hour, ROUND(1 / (1 + exp(-(temp / 10))), 6) AS sig_temp, ROUND(tanh(hum / 10), 6) AS tanh_hum,
       ROUND(exp(-cnt / 10), 6) AS exp_cnt, ROUND(ln(cnt), 6) AS log_cnt, ROUND(sqrt(windspeed), 6) AS sqrt_wind
FROM hourly
""")
def f18_math(spark, sf_dir):
    h = views(spark, sf_dir).hourly
    return h.select("ts_hour",
                    F.round(C.sigmoid(F.col("temp") / 10), 6).alias("sig_temp"),
                    F.round(F.tanh(F.col("hum") / 10), 6).alias("tanh_hum"),
                    F.round(F.exp(-F.col("cnt") / 10), 6).alias("exp_cnt"),
                    F.round(F.log(F.col("cnt")), 6).alias("log_cnt"),
                    F.round(F.sqrt("windspeed"), 6).alias("sqrt_wind"))


@query("f22_dummies", """
WITH levels AS (SELECT DISTINCT 'hr_' || CAST(hr AS VARCHAR) AS name, hr AS value FROM hourly
                UNION ALL SELECT DISTINCT 'weathersit_' || CAST(weathersit AS VARCHAR), weathersit FROM hourly)
SELECT ts_hour, cnt, name, CAST(value = CASE WHEN name LIKE 'hr%' THEN hr ELSE weathersit END AS INTEGER) AS flag FROM hourly, levels
""")
def f22_dummies(spark, sf_dir):
    """The indicator columns, as many as the data has levels, shown as (name, flag) rows."""
    h = views(spark, sf_dir).hourly.select("ts_hour", "cnt", "hr", "weathersit")
    wide = C.dummies(h, ["hr", "weathersit"])
    flags = [F.struct(F.lit(c).alias("name"), F.col(c).alias("flag")) for c in wide.columns if c not in ("ts_hour", "cnt")]
    return wide.select("ts_hour", "cnt", F.inline(F.array(*flags)))


@query("f23_standardize", """
SELECT ts_hour, ROUND((cnt - AVG(cnt) OVER ()) / STDDEV_SAMP(cnt) OVER (), 6) AS cnt,
       ROUND((temp - AVG(temp) OVER ()) / STDDEV_SAMP(temp) OVER (), 6) AS temp,
       ROUND((hum - AVG(hum) OVER ()) / STDDEV_SAMP(hum) OVER (), 6) AS hum
FROM hourly
""")
def f23_standardize(spark, sf_dir):
    h = views(spark, sf_dir).hourly.select("ts_hour", "cnt", "temp", "hum")
    z, _ = C.standardize(h, ["cnt", "temp", "hum"])
    return z.select("ts_hour", *[F.round(c, 6).alias(c) for c in ("cnt", "temp", "hum")])


@query("f24_unstandardize", "SELECT ts_hour, ROUND(CAST(cnt AS DOUBLE), 6) AS cnt FROM hourly")
def f24_unstandardize(spark, sf_dir):
    h = views(spark, sf_dir).hourly.select("ts_hour", "cnt")
    z, stats = C.standardize(h, ["cnt"])
    back = C.unstandardize(z, "cnt", stats)
    return back.select("ts_hour", F.round("cnt", 6).alias("cnt"))
