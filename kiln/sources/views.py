"""Stand-in views: the reference's retail inputs expressed over the test tables.

Each view exists twice: as a DataFrame builder (what the library runs) and as
SQL text (used by the DuckDB oracle through ``with_views``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.sources.tables import Tables


def order_products(t: Tables) -> DataFrame:
    li = t.lineitem
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("reordered"),
    )


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("aisle"),
        F.col("p_type").alias("department"),
    )


def _eval_set():
    return (F.when(F.col("o_orderstatus") == "F", "prior")
             .when(F.col("o_orderstatus") == "O", "train").otherwise("test").alias("eval_set"))


def marked_orders(t: Tables) -> DataFrame:
    """Orders and their set, without the numbering that ``shop_orders`` adds."""
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), _eval_set())


def shop_orders(t: Tables) -> DataFrame:
    """Orders numbered per customer by date, with days since the previous one.

    ``row_number`` / ``lag`` per customer without a window partition per
    customer: a customer holding a large share of all orders is split across
    tasks (see ``number_within``)."""
    from kiln.operators.relational import number_within
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    n = number_within(o, "o_custkey", ["o_orderdate", "o_orderkey"], name="order_number",
                      lag={"o_orderdate": "_prev_date"})
    return n.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        _eval_set(),
        "order_number",
        F.datediff(F.to_date("o_orderdate"), F.to_date("_prev_date")).alias("days_since_prior_order"),
    )


def baskets_long(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey")
    p = t.part.select("p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey)
              .select(F.col("l_orderkey").alias("order_id"), F.col("p_brand").alias("item"))
              .distinct())


def receipt(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    p = t.part.select("p_partkey", "p_type", "p_name")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey)
              .select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("log_month"),
                      F.col("o_custkey").alias("customer_id"),
                      F.col("p_type").alias("pos_large_class_name"),
                      F.col("p_name").alias("item"),
                      F.col("l_extendedprice").cast("decimal(18,2)").alias("sales"),
                      F.col("l_quantity").cast("int").alias("amount")))


def shopper(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.lit(20) + F.lit(10) * (F.col("c_nationkey") % 6)).alias("generation"),
        F.col("c_mktsegment").alias("occupation"),
    )


def hourly(t: Tables) -> DataFrame:
    e = t.events.select("ts", "event_type", "value")
    # wall-clock hour without a zone, like the source column: collected values
    # do not depend on the process or session time zone
    h = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return (e.groupBy(h.alias("ts_hour"))
             .agg(F.count(F.lit(1)).alias("cnt"),
                  F.avg("value").alias("temp"),
                  F.min("value").alias("hum"),
                  F.max("value").alias("windspeed"),
                  (F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)) % 4)
                   .cast("int").alias("weathersit"))
             .select("ts_hour", F.hour("ts_hour").cast("int").alias("hr"),
                     F.dayofmonth("ts_hour").cast("int").alias("mday"),
                     "cnt", "temp", "hum", "windspeed", "weathersit"))


BUILDERS = {
    "order_products": order_products, "products": products, "shop_orders": shop_orders, "marked_orders": marked_orders,
    "baskets_long": baskets_long, "receipt": receipt, "shopper": shopper, "hourly": hourly,
}


class Views(Tables):
    """Tables plus the stand-in views, e.g. ``v.order_products``."""

    def __getattr__(self, name: str) -> DataFrame:
        if name in BUILDERS:
            return BUILDERS[name](self)
        return super().__getattr__(name)


def views(spark: SparkSession, sf_dir: str) -> Views:
    return Views(spark, sf_dir)


# --- the same views as SQL text, for the DuckDB oracle -----------------------

VIEW_SQL = {
    "order_products": "SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS add_to_cart_order, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS reordered FROM lineitem",
    "products": "SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS aisle, p_type AS department FROM part",
    "shop_orders": "SELECT o_orderkey AS order_id, o_custkey AS user_id, CASE o_orderstatus WHEN 'F' THEN 'prior' WHEN 'O' THEN 'train' ELSE 'test' END AS eval_set, CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS order_number, CAST(DATEDIFF('day', LAG(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS INTEGER) AS days_since_prior_order FROM orders",
    "baskets_long": "SELECT DISTINCT l_orderkey AS order_id, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey",
    "receipt": "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS log_month, o_custkey AS customer_id, p_type AS pos_large_class_name, p_name AS item, CAST(l_extendedprice AS DECIMAL(18,2)) AS sales, CAST(l_quantity AS INT) AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
    "shopper": "SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, 20 + 10 * (c_nationkey % 6) AS generation, c_mktsegment AS occupation FROM customer",
    "hourly": "SELECT date_trunc('hour', ts) AS ts_hour, CAST(hour(date_trunc('hour', ts)) AS INT) AS hr, CAST(day(date_trunc('hour', ts)) AS INT) AS mday, COUNT(*) AS cnt, AVG(value) AS temp, MIN(value) AS hum, MAX(value) AS windspeed, CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) % 4 AS INT) AS weathersit FROM events GROUP BY date_trunc('hour', ts)",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every stand-in view it mentions."""
    used = [v for v in VIEW_SQL if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in used)
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
