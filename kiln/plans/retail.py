"""Grocery and receipt queries: joins, grouped summaries, shares, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import relational as R
from kiln.plans.registry import query
from kiln.sources.views import views


@query("t4_best_sellers", """
SELECT c.product_id, c.count, p.product_name
FROM (SELECT product_id, COUNT(*) AS count FROM order_products GROUP BY product_id
      QUALIFY RANK() OVER (ORDER BY COUNT(*) DESC) <= 10) c
LEFT JOIN products p ON c.product_id = p.product_id
""")
def t4_best_sellers(spark, sf_dir, n=10):
    """Best sellers: line count per product, top n with ties, name after the cut."""
    v = views(spark, sf_dir)
    top = R.top_n(R.count_by(v.order_products, "product_id"), n, "count")
    named = R.left_join(top, v.products.select("product_id", "product_name"), "product_id")
    return R.arrange(named, "count", "product_id", desc=("count",))


# --- joins (J1-J6) -------------------------------------------------------------

@query("j1_left_join", """
SELECT o.order_id, o.product_id, o.add_to_cart_order, o.reordered, p.product_name
FROM order_products o LEFT JOIN products p ON o.product_id = p.product_id
""")
def j1_left_join(spark, sf_dir):
    v = views(spark, sf_dir)
    return R.left_join(v.order_products, v.products.select("product_id", "product_name"), "product_id")


@query("j2_left_join_two_keys", """
SELECT s.department, s.aisle, CAST(s.sumcount AS BIGINT) AS sumcount, n.n
FROM (SELECT p.department, p.aisle, COUNT(*) AS sumcount
      FROM order_products o LEFT JOIN products p ON o.product_id = p.product_id
      GROUP BY p.department, p.aisle) s
LEFT JOIN (SELECT department, aisle, COUNT(*) AS n FROM products GROUP BY department, aisle) n
  ON s.department = n.department AND s.aisle = n.aisle
""")
def j2_left_join_two_keys(spark, sf_dir):
    v = views(spark, sf_dir)
    lines = R.left_join(v.order_products.select("product_id"), v.products, "product_id")
    sums = R.count_by(lines, ["department", "aisle"], "sumcount")
    counts = R.count_by(v.products, ["department", "aisle"], "n")
    return R.left_join(sums, counts, ["department", "aisle"])


@query("j3_natural_left_join", """
SELECT r.log_month, r.customer_id, r.pos_large_class_name, r.item, CAST(r.sales AS DOUBLE) AS sales,
       r.amount, s.gender, s.generation, s.occupation
FROM receipt r LEFT JOIN shopper s ON r.customer_id = s.customer_id
""")
def j3_natural_left_join(spark, sf_dir):
    v = views(spark, sf_dir)
    return (R.natural_left_join(v.receipt, v.shopper)
             .withColumn("sales", F.col("sales").cast("double")))


def _order_level(v):
    return v.order_products.groupBy("order_id").agg(F.avg("reordered").alias("m"), R.n().alias("n"))


@query("j4_right_join", """
SELECT o.order_id, l.m, l.n, o.user_id, o.eval_set, o.order_number, o.days_since_prior_order
FROM (SELECT order_id, AVG(reordered) AS m, COUNT(*) AS n FROM order_products GROUP BY order_id) l
RIGHT JOIN (SELECT * FROM shop_orders WHERE order_number > 2) o ON l.order_id = o.order_id
""")
def j4_right_join(spark, sf_dir):
    v = views(spark, sf_dir)
    return R.right_join(_order_level(v), v.shop_orders.where(F.col("order_number") > 2), "order_id")


@query("j5_merge_sorted", """
SELECT o.product_id, o.order_id, p.product_name, p.aisle, p.department
FROM order_products o JOIN products p ON o.product_id = p.product_id
""")
def j5_merge_sorted(spark, sf_dir):
    v = views(spark, sf_dir)
    return R.merge(v.order_products.select("order_id", "product_id"), v.products, "product_id")


@query("j6_semi_join", """
SELECT * FROM order_products
WHERE order_id IN (SELECT order_id FROM shop_orders WHERE eval_set = 'prior')
""")
def j6_semi_join(spark, sf_dir):
    v = views(spark, sf_dir)
    return R.semi_join(v.order_products, v.marked_orders.where(F.col("eval_set") == "prior"), "order_id")


# --- aggregations (G1-G12, G14-G16) ----------------------------------------------

@query("g1_count_by", """
SELECT product_id, add_to_cart_order, COUNT(*) AS count FROM order_products
GROUP BY product_id, add_to_cart_order
""")
def g1_count_by(spark, sf_dir):
    return R.count_by(views(spark, sf_dir).order_products, ["product_id", "add_to_cart_order"])


@query("g2_rate_by", """
SELECT product_id, AVG(reordered) AS proportion_reordered, COUNT(*) AS n
FROM order_products GROUP BY product_id
""")
def g2_rate_by(spark, sf_dir):
    return R.rate_by(views(spark, sf_dir).order_products, "product_id", "reordered",
                     name="proportion_reordered")


@query("g3_sum_by", """
SELECT customer_id, log_month, CAST(SUM(sales) AS DOUBLE) AS SUM_sales
FROM receipt GROUP BY customer_id, log_month
""")
def g3_sum_by(spark, sf_dir):
    s = R.sum_by(views(spark, sf_dir).receipt, ["customer_id", "log_month"], "sales", "SUM_sales")
    return s.withColumn("SUM_sales", F.col("SUM_sales").cast("double"))


def _cus_and_rec(v):
    return R.natural_left_join(v.receipt, v.shopper)


@query("g4_stats", """
SELECT ROUND(AVG(CAST(sales AS DOUBLE)), 6) AS SALES_MEAN, ROUND(STDDEV_SAMP(CAST(sales AS DOUBLE)), 6) AS SALES_SD,
       ROUND(MEDIAN(CAST(sales AS DOUBLE)), 6) AS SALES_MED, ROUND(AVG(amount), 6) AS AMOUNT_MEAN,
       ROUND(STDDEV_SAMP(amount), 6) AS AMOUNT_SD, ROUND(MEDIAN(CAST(amount AS DOUBLE)), 6) AS AMOUNT_MED,
       COUNT(*) AS count
FROM receipt r LEFT JOIN shopper s ON r.customer_id = s.customer_id
WHERE pos_large_class_name = 'SMALL'
""")
def g4_stats(spark, sf_dir, klass="SMALL"):
    """Whole-table summary of two measures after a filter (R semantics: any
    missing value makes the statistic missing)."""
    d = (_cus_and_rec(views(spark, sf_dir)).where(F.col("pos_large_class_name") == klass)
         .select(F.col("sales").cast("double").alias("sales"), F.col("amount").cast("double").alias("amount")))
    s = R.stats(d, ["sales", "amount"])
    out = []
    for c, up in (("sales", "SALES"), ("amount", "AMOUNT")):
        out += [F.round(f"{c}_mean", 6).alias(f"{up}_MEAN"), F.round(f"{c}_sd", 6).alias(f"{up}_SD"),
                F.round(f"{c}_median", 6).alias(f"{up}_MED")]
    return s.select(*out, "count")


@query("g5_last_by", """
SELECT order_id, MAX(add_to_cart_order) AS n_items FROM order_products GROUP BY order_id
""")
def g5_last_by(spark, sf_dir):
    return R.last_by(views(spark, sf_dir).order_products, "order_id", "add_to_cart_order",
                     "add_to_cart_order", name="n_items")


@query("g6_basket_sizes", """
SELECT n_items, COUNT(*) AS count
FROM (SELECT order_id, MAX(add_to_cart_order) AS n_items FROM order_products GROUP BY order_id)
GROUP BY n_items
""")
def g6_basket_sizes(spark, sf_dir):
    return R.basket_sizes(views(spark, sf_dir).order_products, "order_id", "add_to_cart_order")


def _loyalty(v):
    """Per user over orders numbered above 2 and marked prior: orders whose lines
    were all re-orders (missing mean skipped) and their share of all orders."""
    tmp = R.right_join(_order_level(v), v.shop_orders.where(F.col("order_number") > 2), "order_id")
    return tmp, R.cond_share(tmp.where(F.col("eval_set") == "prior"), "user_id", F.col("m") == 1)


@query("g7_cond_share", """
SELECT user_id, CAST(COUNT(*) FILTER (WHERE m = 1) AS BIGINT) AS n_equal,
       COUNT(*) FILTER (WHERE m = 1) / COUNT(*) AS percent_equal
FROM (SELECT o.user_id, o.eval_set, l.m
      FROM (SELECT order_id, AVG(reordered) AS m FROM order_products GROUP BY order_id) l
      RIGHT JOIN (SELECT * FROM shop_orders WHERE order_number > 2) o ON l.order_id = o.order_id)
WHERE eval_set = 'prior' GROUP BY user_id
""")
def g7_cond_share(spark, sf_dir):
    return _loyalty(views(spark, sf_dir))[1]


@query("g8_unit_value", """
SELECT pos_large_class_name, generation, CAST(SUM(amount * sales) AS DOUBLE) AS SUM_value, COUNT(*) AS count,
       CAST(SUM(amount * sales) AS DOUBLE) / COUNT(*) AS spu
FROM receipt r LEFT JOIN shopper s ON r.customer_id = s.customer_id
WHERE gender = 'F' GROUP BY pos_large_class_name, generation
""")
def g8_unit_value(spark, sf_dir):
    d = (_cus_and_rec(views(spark, sf_dir)).where(F.col("gender") == "F")
         .withColumn("value", F.col("amount") * F.col("sales")))
    return (d.groupBy("pos_large_class_name", "generation")
             .agg(F.sum("value").cast("double").alias("SUM_value"), R.n().alias("count"))
             .withColumn("spu", F.col("SUM_value") / F.col("count")))


@query("g9_multi_group", """
SELECT pos_large_class_name, gender, generation,
       GROUPING_ID(pos_large_class_name, gender, generation) AS grouping_id,
       CAST(SUM(sales) AS DOUBLE) AS SUM_sales
FROM receipt r LEFT JOIN shopper s ON r.customer_id = s.customer_id
GROUP BY GROUPING SETS ((pos_large_class_name, gender, generation), (pos_large_class_name, gender),
                        (pos_large_class_name, generation), (gender), (generation))
""")
def g9_multi_group(spark, sf_dir):
    sets = [["pos_large_class_name", "gender", "generation"], ["pos_large_class_name", "gender"],
            ["pos_large_class_name", "generation"], ["gender"], ["generation"]]
    g = R.multi_group(_cus_and_rec(views(spark, sf_dir)), sets, "sales", "SUM_sales")
    return g.withColumn("SUM_sales", F.col("SUM_sales").cast("double"))


@query("g10_hierarchy", """
WITH tmp AS (SELECT department, aisle, COUNT(*) AS n FROM products GROUP BY department, aisle),
pc AS (SELECT product_id, COUNT(*) AS count FROM order_products GROUP BY product_id),
s AS (SELECT p.department, p.aisle, CAST(SUM(pc.count) AS BIGINT) AS sumcount
      FROM pc LEFT JOIN products p ON pc.product_id = p.product_id GROUP BY p.department, p.aisle)
SELECT s.department, s.aisle, s.sumcount, tmp.n, 1 AS onesize
FROM s LEFT JOIN tmp ON s.department = tmp.department AND s.aisle = tmp.aisle
""")
def g10_hierarchy(spark, sf_dir):
    """Aggregate, join names, aggregate again, join the product-count level.
    Lines are counted per product before the product join (written that way)."""
    v = views(spark, sf_dir)
    tmp = R.count_by(v.products, ["department", "aisle"], "n")
    pc = R.count_by(v.order_products, "product_id")
    s = (R.left_join(pc, v.products, "product_id")
         .groupBy("department", "aisle").agg(F.sum("count").alias("sumcount")))
    return R.left_join(s, tmp, ["department", "aisle"]).withColumn("onesize", F.lit(1))


@query("g11_max_count", """
SELECT MAX(count) AS max_count
FROM (SELECT r.customer_id, COUNT(*) AS count FROM receipt r LEFT JOIN shopper s ON r.customer_id = s.customer_id
      GROUP BY r.customer_id)
""")
def g11_max_count(spark, sf_dir):
    return R.count_by(_cus_and_rec(views(spark, sf_dir)), "customer_id").agg(F.max("count").alias("max_count"))


@query("g12_lists_by", """
SELECT order_id, list_sort(list(product_id)) AS product_id_list FROM order_products GROUP BY order_id
""")
def g12_lists_by(spark, sf_dir):
    return R.lists_by(views(spark, sf_dir).order_products, "order_id", "product_id")


@query("g14_reorder_by_gap", """
SELECT o.days_since_prior_order, AVG(l.reordered) AS mean_reorder
FROM order_products l LEFT JOIN shop_orders o ON l.order_id = o.order_id
GROUP BY o.days_since_prior_order
""")
def g14_reorder_by_gap(spark, sf_dir):
    v = views(spark, sf_dir)
    j = R.left_join(v.order_products, v.shop_orders.select("order_id", "days_since_prior_order"), "order_id")
    return j.groupBy("days_since_prior_order").agg(F.avg("reordered").alias("mean_reorder"))


@query("g15_flag_share", """
WITH f AS (SELECT product_id, CASE WHEN regexp_matches(lower(product_name), 'red') THEN 'red'
                                   WHEN product_name IS NOT NULL THEN 'not red' END AS red FROM products),
g AS (SELECT f.red, COUNT(*) AS count, AVG(l.reordered) AS mean_reordered
      FROM order_products l LEFT JOIN f ON l.product_id = f.product_id GROUP BY f.red)
SELECT red, count, count / SUM(count) OVER () AS proportion, mean_reordered FROM g
""")
def g15_flag_share(spark, sf_dir, pattern="red"):
    from kiln.functions.columns import flag_contains
    v = views(spark, sf_dir)
    flags = v.products.select("product_id", flag_contains("product_name", pattern, pattern,
                                                          f"not {pattern}").alias(pattern))
    g = (R.left_join(v.order_products, flags, "product_id")
         .groupBy(pattern).agg(R.n().alias("count"), F.avg("reordered").alias("mean_reordered")))
    return R.share(g, "count").select(pattern, "count", "proportion", "mean_reordered")


@query("g16_monthly_trend", """
SELECT log_month, gender, generation, CAST(SUM(sales) AS DOUBLE) AS SUM_sales,
       concat(coalesce(CAST(gender AS VARCHAR), 'NA'), coalesce(CAST(generation AS VARCHAR), 'NA')) AS gen_gene
FROM receipt r LEFT JOIN shopper s ON r.customer_id = s.customer_id
GROUP BY log_month, gender, generation
""")
def g16_monthly_trend(spark, sf_dir):
    from kiln.functions.columns import paste0
    s = R.sum_by(_cus_and_rec(views(spark, sf_dir)), ["log_month", "gender", "generation"], "sales", "SUM_sales")
    return R.arrange(s.withColumn("SUM_sales", F.col("SUM_sales").cast("double"))
                      .withColumn("gen_gene", paste0("gender", "generation")),
                     "log_month", "gen_gene")


# --- shares and ordered cuts (W1, W2, W4-W7) -------------------------------------------

@query("w1_share_total", """
SELECT reordered, COUNT(*) AS count, COUNT(*) / SUM(COUNT(*)) OVER () AS proportion
FROM order_products GROUP BY reordered
""")
def w1_share_total(spark, sf_dir):
    return R.share(R.count_by(views(spark, sf_dir).order_products, "reordered"), "count")


@query("w2_share_within", """
SELECT product_id, add_to_cart_order, COUNT(*) AS count,
       COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY product_id) AS pct
FROM order_products GROUP BY product_id, add_to_cart_order
""")
def w2_share_within(spark, sf_dir):
    c = R.count_by(views(spark, sf_dir).order_products, ["product_id", "add_to_cart_order"])
    return R.share(c, "count", by="product_id", name="pct")


@query("w4_time_split", """
SELECT ts_hour, cnt, CASE WHEN rn <= 168 THEN 'test' WHEN rn <= 408 THEN 'validation' ELSE 'train' END AS split
FROM (SELECT ts_hour, cnt, ROW_NUMBER() OVER (ORDER BY ts_hour DESC) AS rn FROM hourly)
""")
def w4_time_split(spark, sf_dir, test_n=7 * 24, val_n=10 * 24):
    h = views(spark, sf_dir).hourly.select("ts_hour", "cnt")
    return R.time_split(h, "ts_hour", test_n, val_n)


@query("w5_first_rows", """
SELECT ts_hour, cnt, temp FROM hourly ORDER BY ts_hour LIMIT 240
""")
def w5_first_rows(spark, sf_dir, n=240):
    return R.first_rows(views(spark, sf_dir).hourly.select("ts_hour", "cnt", "temp"), n, "ts_hour")


@query("w6_fraction_split", """
SELECT ts_hour, cnt, CASE WHEN ROW_NUMBER() OVER (ORDER BY ts_hour) <= FLOOR(COUNT(*) OVER () * 0.8)
                          THEN 'train' ELSE 'test' END AS split
FROM hourly
""")
def w6_fraction_split(spark, sf_dir, frac=0.2):
    h = views(spark, sf_dir).hourly.select("ts_hour", "cnt")
    return R.fraction_split(h, "ts_hour", frac).drop("_pos")


@query("w7_ranked", """
SELECT product_id, count, ROW_NUMBER() OVER (ORDER BY count DESC, product_id) AS rank
FROM (SELECT product_id, COUNT(*) AS count FROM order_products GROUP BY product_id)
""")
def w7_ranked(spark, sf_dir):
    c = R.count_by(views(spark, sf_dir).order_products, "product_id")
    return R.ranked(c, "count", tiebreak=("product_id",))


# --- sort, top-k, sampling (T1-T3, T5-T9) ------------------------------------------------

@query("t1_arrange", """
SELECT * FROM shop_orders ORDER BY days_since_prior_order DESC NULLS LAST, order_id
""")
def t1_arrange(spark, sf_dir):
    return R.arrange(views(spark, sf_dir).shop_orders, "days_since_prior_order", "order_id",
                     desc=("days_since_prior_order",))


@query("t2_top_n_ties", """
SELECT product_id, proportion_reordered, n FROM
(SELECT product_id, AVG(reordered) AS proportion_reordered, COUNT(*) AS n FROM order_products GROUP BY product_id)
QUALIFY RANK() OVER (ORDER BY proportion_reordered DESC) <= 10
""")
def t2_top_n_ties(spark, sf_dir):
    return R.top_n(g2_rate_by(spark, sf_dir), 10, "proportion_reordered")


@query("t3_sorted_head", """
SELECT product_id, COUNT(*) AS count FROM order_products GROUP BY product_id
ORDER BY count DESC, product_id LIMIT 5
""")
def t3_sorted_head(spark, sf_dir):
    c = R.count_by(views(spark, sf_dir).order_products, "product_id")
    return R.sorted_head(c, 5, F.col("count").desc(), "product_id")


@query("t5_top_rate", """
SELECT t.product_id, t.proportion_reordered, t.n, p.product_name, p.aisle, p.department
FROM (SELECT product_id, AVG(reordered) AS proportion_reordered, COUNT(*) AS n
      FROM order_products GROUP BY product_id HAVING COUNT(*) > 40
      QUALIFY RANK() OVER (ORDER BY AVG(reordered) DESC) <= 10) t
LEFT JOIN products p ON t.product_id = p.product_id
""")
def t5_top_rate(spark, sf_dir, min_n=40, n=10):
    v = views(spark, sf_dir)
    r = g2_rate_by(spark, sf_dir).where(F.col("n") > min_n)
    top = R.arrange(R.top_n(r, n, "proportion_reordered"), "proportion_reordered", "product_id",
                    desc=("proportion_reordered",))
    return R.left_join(top, v.products, "product_id")


@query("t6_first_in_cart", """
SELECT product_name, pct, count FROM
(SELECT p.product_name, c.pct, c.count FROM
  (SELECT product_id, COUNT(*) FILTER (WHERE add_to_cart_order = 1) AS count,
          COUNT(*) FILTER (WHERE add_to_cart_order = 1) / COUNT(*) AS pct
   FROM order_products GROUP BY product_id) c
  LEFT JOIN products p ON c.product_id = p.product_id
 WHERE c.count > 10)
QUALIFY RANK() OVER (ORDER BY pct DESC) <= 10
""")
def t6_first_in_cart(spark, sf_dir, min_count=10, n=10):
    """Share of a product's lines that were first in the cart. One aggregate per
    product gives both the position-1 count and the product total (the grouped
    share of the reference without a second shuffle)."""
    v = views(spark, sf_dir)
    c = (v.order_products.groupBy("product_id")
         .agg(F.count_if(F.col("add_to_cart_order") == 1).alias("count"), R.n().alias("_n"))
         .withColumn("pct", F.col("count") / F.col("_n")).where(F.col("count") > min_count))
    named = R.left_join(c, v.products, "product_id").select("product_name", "pct", "count")
    return R.top_n(named, n, "pct")


@query("t7_loyal_users", """
WITH l AS (SELECT order_id, AVG(reordered) AS m FROM order_products GROUP BY order_id),
tmp AS (SELECT o.order_id, o.user_id, o.eval_set, l.m FROM l RIGHT JOIN
        (SELECT * FROM shop_orders WHERE order_number > 2) o ON l.order_id = o.order_id),
loyal AS (SELECT user_id, COUNT(*) FILTER (WHERE m = 1) AS n_equal FROM tmp WHERE eval_set = 'prior'
          GROUP BY user_id HAVING COUNT(*) FILTER (WHERE m = 1) / COUNT(*) = 1)
SELECT loyal.user_id, loyal.n_equal, tmp.order_id, op.product_id, op.add_to_cart_order, op.reordered,
       p.product_name, p.aisle, p.department
FROM loyal JOIN tmp ON loyal.user_id = tmp.user_id
JOIN order_products op ON op.order_id = tmp.order_id
LEFT JOIN products p ON op.product_id = p.product_id
""")
def t7_loyal_users(spark, sf_dir):
    """Users all of whose (numbered > 2, prior) orders were pure re-orders, then
    the lines and product names of their orders."""
    v = views(spark, sf_dir)
    tmp, share_ = _loyalty(v)
    loyal = share_.where(F.col("percent_equal") == 1).select("user_id", "n_equal")
    their_orders = tmp.select("order_id", "user_id").join(loyal, "user_id")
    lines = v.order_products.join(their_orders, "order_id")
    out = R.left_join(lines, v.products, "product_id")
    return R.arrange(out.select("user_id", "n_equal", "order_id", "product_id", "add_to_cart_order",
                                "reordered", "product_name", "aisle", "department"),
                     "n_equal", "user_id", "order_id", "add_to_cart_order", desc=("n_equal",))


@query("t8_sample_with_replacement", """
WITH numbered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ts_hour) - 1 AS pos, COUNT(*) OVER () AS n FROM hourly),
draws AS (SELECT range AS draw, CAST('0x' || substr(md5('42:' || range), 1, 8) AS BIGINT) AS h FROM range(128))
SELECT draws.draw, numbered.* EXCLUDE (pos, n) FROM draws JOIN numbered ON numbered.pos = draws.h % numbered.n
""")
def t8_sample_with_replacement(spark, sf_dir, n=128, seed=42):
    h = views(spark, sf_dir).hourly
    return R.sample_n(h, n, seed=seed, replace=True, order="ts_hour")


@query("t9_sample_without_replacement", """
SELECT * FROM products ORDER BY substr(md5('7:' || product_id), 1, 8), product_id LIMIT 10
""")
def t9_sample_without_replacement(spark, sf_dir, n=10, seed=7):
    return R.sample_n(views(spark, sf_dir).products, n, seed=seed, key="product_id")


# --- set operations (U1-U3) ----------------------------------------------------------

@query("u1_bind_rows", """
SELECT * FROM shop_orders WHERE eval_set = 'prior'
UNION ALL SELECT * FROM shop_orders WHERE order_number <= 2
""")
def u1_bind_rows(spark, sf_dir):
    o = views(spark, sf_dir).shop_orders
    return R.bind_rows(o.where(F.col("eval_set") == "prior"), o.where(F.col("order_number") <= 2))


@query("u2_bind_cols", """
SELECT ts_hour, cnt, temp,
       ROUND((cnt - AVG(cnt) OVER ()) / STDDEV_SAMP(cnt) OVER (), 6) AS cnt_z,
       ROUND((temp - AVG(temp) OVER ()) / STDDEV_SAMP(temp) OVER (), 6) AS temp_z
FROM hourly
""")
def u2_bind_cols(spark, sf_dir):
    from kiln.functions.columns import standardize
    h = views(spark, sf_dir).hourly.select("ts_hour", "cnt", "temp")
    z, _ = standardize(h.select("ts_hour", "cnt", "temp"), ["cnt", "temp"], suffix="_z")
    z = z.select("ts_hour", F.round("cnt_z", 6).alias("cnt_z"), F.round("temp_z", 6).alias("temp_z"))
    return R.bind_cols(h, z, "ts_hour")


@query("u3_visit_cohorts", """
WITH cr AS (SELECT r.* FROM receipt r LEFT JOIN shopper s ON r.customer_id = s.customer_id),
uc AS (SELECT customer_id, COUNT(*) AS count FROM cr GROUP BY customer_id)
SELECT cr.pos_large_class_name, CAST(SUM(cr.amount) AS BIGINT) AS amount,
       CASE WHEN uc.count < 20 THEN 'U20' ELSE 'O20' END AS type
FROM cr JOIN uc ON cr.customer_id = uc.customer_id
GROUP BY cr.pos_large_class_name, CASE WHEN uc.count < 20 THEN 'U20' ELSE 'O20' END
""")
def u3_visit_cohorts(spark, sf_dir, threshold=20):
    """Customers under / from ``threshold`` receipt lines, amount per class for
    each cohort, bound with a tag. One join of per-customer counts replaces the
    two membership filters; the union is the grouping on the tag."""
    cr = _cus_and_rec(views(spark, sf_dir))
    uc = R.count_by(cr, "customer_id")
    tagged = cr.join(uc, "customer_id").withColumn(
        "type", F.when(F.col("count") < threshold, F.lit(f"U{threshold}")).otherwise(F.lit(f"O{threshold}")))
    return tagged.groupBy("pos_large_class_name", "type").agg(F.sum("amount").alias("amount"))
