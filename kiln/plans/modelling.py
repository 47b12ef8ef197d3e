"""Modelling queries (M1-M16, Q11, Q13, Q15) on the hourly series, receipts,
baskets and embeddings. Random or iterative results are checked by
properties in the tests (row counts here)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from kiln.functions.arrays import argmax
from kiln.functions.columns import dummies, standardize
from kiln.operators import forest_search as FS
from kiln.operators import models as M
from kiln.operators import network as N
from kiln.operators import relational as R
from kiln.operators.basket import baskets
from kiln.operators.kernel import SupportRegressor, gathered
from kiln.operators.neighbours import NeighbourBag
from kiln.operators.sgd import SgdRegressor
from kiln.operators.tree import reg_tree
from kiln.plans.registry import query
from kiln.sources.tables import Tables
from kiln.sources.views import views

SEED = 42
NUMERIC = ["temp", "hum", "windspeed", "mday"]


def hourly_features(spark, sf_dir):
    """Hourly table with one-hot hour and weather codes, the assembled feature
    vector, ``label = cnt`` and a seeded 80/20 hash split."""
    h = views(spark, sf_dir).hourly
    d = dummies(h.select("ts_hour", "cnt", *NUMERIC, "hr", "weathersit"), ["hr", "weathersit"])
    feats = [c for c in d.columns if c not in ("ts_hour", "cnt")]
    d = M.holdout(d.withColumn("label", F.col("cnt").cast("double")), 0.2, SEED, "ts_hour")
    return M.assemble(d, feats), feats


def _split(spark, sf_dir):
    d, feats = hourly_features(spark, sf_dir)
    return d.where(F.col("split") == "train"), d.where(F.col("split") == "test"), feats


@query("m1_holdout", f"""
SELECT ts_hour, cnt, CASE WHEN substr(md5('{SEED}:' || CAST(ts_hour AS VARCHAR)), 1, 8) < '{int(0.2 * 2 ** 32):08x}' THEN 'test'
                          ELSE 'train' END AS split FROM hourly
""")
def m1_holdout(spark, sf_dir):
    h = views(spark, sf_dir).hourly.select("ts_hour", "cnt")
    return M.holdout(h, 0.2, SEED, "ts_hour")


@query("m2_ols", """
SELECT ROUND(regr_slope(cnt, temp), 6) AS slope, ROUND(regr_intercept(cnt, temp), 6) AS intercept FROM hourly
""")
def m2_ols(spark, sf_dir):
    h = M.assemble(views(spark, sf_dir).hourly.withColumn("label", F.col("cnt").cast("double")), ["temp"])
    m = M.ols().fit(h)
    return spark.createDataFrame([(float(m.coefficients[0]), float(m.intercept))], "slope double, intercept double") \
                .select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


def _coef_table(spark, model, feats):
    rows = [(f, float(c)) for f, c in zip(feats, model.coefficients.toArray())] + [("(intercept)", float(model.intercept))]
    return spark.createDataFrame(rows, "feature string, coef double")


@query("m3_lasso")
def m3_lasso(spark, sf_dir, alpha=0.1):
    tr, _, feats = _split(spark, sf_dir)
    return _coef_table(spark, M.lasso(alpha).fit(tr), feats)


@query("m4_ridge")
def m4_ridge(spark, sf_dir, alpha=0.5):
    tr, _, feats = _split(spark, sf_dir)
    sd, n = M.label_stats(tr, "label")
    return _coef_table(spark, M.ridge(alpha, sd, n).fit(tr), feats)


@query("m5_enet")
def m5_enet(spark, sf_dir, alpha=1.0, rho=0.5):
    tr, _, feats = _split(spark, sf_dir)
    sd, _ = M.label_stats(tr, "label")
    return _coef_table(spark, M.enet(alpha, rho, sd).fit(tr), feats)


def _predict(est, spark, sf_dir):
    tr, te, _ = _split(spark, sf_dir)
    return est.fit(tr).transform(te).select("ts_hour", "cnt", "prediction")


@query("m6_forest")
def m6_forest(spark, sf_dir):
    return _predict(M.forest(seed=SEED), spark, sf_dir)


@query("m7_bagged_trees")
def m7_bagged_trees(spark, sf_dir):
    return _predict(M.bagged_trees(seed=SEED), spark, sf_dir)


@query("m8_boosted")
def m8_boosted(spark, sf_dir):
    """Held-out rows predicted by both boosters."""
    tr, te, _ = _split(spark, sf_dir)
    by_depth = M.boosted("depth").fit(tr).transform(te, "by_depth")
    return M.boosted("leaf").fit(tr).transform(by_depth).select("ts_hour", "cnt", "prediction", "by_depth")


def receipt_tree(spark, sf_dir):
    """Receipts with customer fields and visit counts, value = amount * sales, and
    a tree of value on the remaining columns, the amount among them."""
    v = views(spark, sf_dir)
    cr = R.natural_left_join(v.receipt, v.shopper)
    uc = R.count_by(cr, "customer_id")
    d = cr.join(uc, "customer_id").withColumn("value", (F.col("amount") * F.col("sales")).cast("decimal(18,2)")).drop("item", "sales")
    return d, reg_tree(d, "value")


#: Columns of the tree's table in their order: number of the feature, SQL of its number or its text.
_TREE = {"customer_id": ("num", "customer_id"), "log_month": ("num", "datediff('day', DATE '1970-01-01', log_month)"),
         "pos_large_class_name": ("txt", "pos_large_class_name"), "amount": ("num", "amount"), "gender": ("txt", "gender"),
         "generation": ("num", "generation"), "occupation": ("txt", "occupation"), "count": ("num", "visits")}
_TREE_LEVELS = 30


def _tree_sql(select: str, cp: float = 0.01, min_split: int = 20, min_leaf: int = 7, levels: int = _TREE_LEVELS) -> str:
    """The grown and pruned tree, one group of expressions for each level. The data
    of the oracle's scale have no open node after so many."""
    melt = ", ".join(f"{{'f': {i}, 'num': {sql if kind == 'num' else 'NULL'}::DOUBLE, 'txt': {sql if kind == 'txt' else 'NULL'}::VARCHAR}}"
                     for i, (kind, sql) in enumerate(_TREE.values()))
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(_TREE)) + " END"
    dev = "greatest(0, q::DOUBLE - s::DOUBLE * s::DOUBLE / n)"
    ctes = [f"""cr AS (SELECT * FROM receipt LEFT JOIN shopper USING (customer_id)),
b0 AS MATERIALIZED (SELECT row_number() OVER () AS rid, *, (amount * sales)::DECIMAL(18,2) AS value, (count(*) OVER (PARTITION BY customer_id)) AS visits FROM cr),
m AS MATERIALIZED (SELECT rid, value, unnest([{melt}], recursive := true) FROM b0),
r0 AS MATERIALIZED (SELECT rid, value, 1::BIGINT AS node FROM b0)"""]
    for d in range(levels):
        ctes.append(f"""t{d} AS MATERIALIZED (SELECT node, count(*) AS n, sum(value) AS s, sum(value * value) AS q FROM r{d} GROUP BY node),
a{d} AS MATERIALIZED (SELECT node FROM t{d} WHERE n >= {min_split} AND {dev} > {cp} * (SELECT {dev} FROM t0)),
e{d} AS (SELECT node, f, num, txt, count(*) AS n, sum(m.value) AS s FROM r{d} JOIN m USING (rid) SEMI JOIN a{d} USING (node)
         WHERE num IS NOT NULL OR txt IS NOT NULL GROUP BY node, f, num, txt),
o{d} AS (SELECT *, CASE WHEN txt IS NOT NULL THEN s::DOUBLE / n ELSE num END AS place FROM e{d}),
c{d} AS MATERIALIZED (SELECT node, f, num, txt, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER p AS na, sum(s) OVER p AS sa,
         lead(num) OVER w AS nxt FROM o{d} WINDOW w AS (PARTITION BY node, f ORDER BY place, txt), p AS (PARTITION BY node, f)),
g{d} AS (SELECT *, sl::DOUBLE * sl::DOUBLE / nl + (sa - sl)::DOUBLE * (sa - sl)::DOUBLE / (na - nl) - sa::DOUBLE * sa::DOUBLE / na AS gain
         FROM c{d} WHERE nl >= {min_leaf} AND na - nl >= {min_leaf}),
x{d} AS MATERIALIZED (SELECT node, f, (num + nxt) / 2 AS threshold, CASE WHEN txt IS NOT NULL THEN (SELECT list(c.txt ORDER BY c.txt) FROM c{d} c
           WHERE c.node = g{d}.node AND c.f = g{d}.f AND c.nl <= g{d}.nl) END AS categories
         FROM g{d} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, nl) = 1),
r{d + 1} AS MATERIALIZED (SELECT rid, value, 2 * node + CASE WHEN coalesce(num <= threshold, list_contains(categories, txt)) THEN 0 ELSE 1 END AS node
         FROM r{d} JOIN x{d} USING (node) JOIN m USING (rid, f, value))""")
    ctes.append(f"t{levels} AS (SELECT node, count(*) AS n, sum(value) AS s, sum(value * value) AS q FROM r{levels} GROUP BY node)")
    leaf = f"{dev} + {cp} * (SELECT {dev} FROM t0)"
    ctes.append(f"k{levels} AS (SELECT node, {leaf} AS cost, FALSE AS split FROM t{levels})")
    for d in reversed(range(levels)):
        ctes.append(f"""k{d} AS MATERIALIZED (SELECT node, coalesce(least({leaf}, below), {leaf}) AS cost, coalesce(below < {leaf}, FALSE) AS split
         FROM t{d} LEFT JOIN (SELECT node // 2 AS node, sum(cost) AS below FROM k{d + 1} GROUP BY 1) USING (node))""")
    ctes.append("h0 AS (SELECT node, split FROM k0)")
    for d in range(levels):
        ctes.append(f"h{d + 1} AS (SELECT k.node, k.split FROM k{d + 1} k JOIN h{d} ON k.node // 2 = h{d}.node AND h{d}.split)")

    def each(what, last):
        return " UNION ALL ".join(f"SELECT * FROM {what}{d}" for d in range(last))
    ctes.append(f"""nodes AS (SELECT h.node AS id, t.n, t.s, t.q, h.split, {names} AS feature, threshold, categories
         FROM ({each("h", levels + 1)}) h JOIN ({each("t", levels + 1)}) t USING (node) LEFT JOIN ({each("x", levels)}) x ON x.node = h.node AND h.split)""")
    ctes.append(f"""leaves AS (SELECT rid, r.node, t.s, t.n FROM ({each("r", levels + 1).replace("*", "rid, node")}) r
         JOIN ({each("h", levels + 1)}) h ON r.node = h.node AND NOT h.split JOIN ({each("t", levels + 1)}) t ON t.node = h.node)""")
    return "WITH " + ",\n".join(ctes) + "\n" + select


@query("m9_reg_tree", _tree_sql("""
SELECT customer_id, log_month, value::DOUBLE AS value, node AS leaf, ROUND(s::DOUBLE / n, 4) AS prediction FROM leaves JOIN b0 USING (rid)"""))
def m9_reg_tree(spark, sf_dir):
    d, tree = receipt_tree(spark, sf_dir)
    return tree.predict(d).select("customer_id", "log_month", F.col("value").cast("double").alias("value"), "leaf", F.round("prediction", 4).alias("prediction"))


@query("m10_tree_nodes", _tree_sql("""
SELECT id, ROUND(s::DOUBLE / n, 4) AS prediction, ROUND(sqrt(greatest(0, (q::DOUBLE - s::DOUBLE * s::DOUBLE / n) / n)), 4) AS sd, n,
       CASE WHEN split THEN 2 * id END AS "left", CASE WHEN split THEN 2 * id + 1 END AS "right", feature, threshold, categories
FROM nodes"""))
def m10_tree_nodes(spark, sf_dir):
    """The node table; the spread of a node as the square root of its impurity."""
    _, tree = receipt_tree(spark, sf_dir)
    return tree.table(spark).select("id", F.round("prediction", 4).alias("prediction"), F.round(F.sqrt("impurity"), 4).alias("sd"), "n",
                                    "left", "right", "feature", "threshold", "categories")


def _models(tr):
    """The thirteen models of the comparison, with the library's settings."""
    sd, n = M.label_stats(tr, "label")
    return {"sgd": SgdRegressor(seed=SEED), "lasso": M.lasso(0.1), "elastic_net": M.enet(1.0, 0.5, sd), "ridge": M.ridge(0.5, sd, n),
            "svr_linear": SupportRegressor("linear"), "svr_rbf": SupportRegressor("rbf"), "bagged_trees": M.bagged_trees(seed=SEED),
            "bagged_neighbours": NeighbourBag(seed=SEED), "nu_svr": SupportRegressor("rbf", nu=0.5), "forest": M.forest(300, seed=SEED),
            "boosted_depth": M.boosted("depth"), "linear": M.ols(), "boosted_leaf": M.boosted("leaf")}


@query("m11_leaderboard")
def m11_leaderboard(spark, sf_dir):
    tr, te, _ = _split(spark, sf_dir)
    tr, te = gathered(tr), gathered(te)
    try:
        return M.leaderboard(_models(tr), tr, te)
    finally:
        tr.unpersist()
        te.unpersist()


@query("m12_evaluate", """
WITH s AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY ts_hour) <= FLOOR(COUNT(*) OVER () * 0.8)
                          THEN 'train' ELSE 'test' END AS split FROM hourly),
m AS (SELECT hr, AVG(cnt) AS p FROM s WHERE split = 'train' GROUP BY hr),
j AS (SELECT s.split AS dataset, CAST(s.cnt AS DOUBLE) AS y, m.p FROM s JOIN m ON s.hr = m.hr)
SELECT dataset, ROUND(AVG((y - p) ^ 2), 6) AS mse,
       ROUND(CASE WHEN MIN(LEAST(y, p)) >= 0 THEN sqrt(AVG((ln(1 + y) - ln(1 + p)) ^ 2)) END, 6) AS rmsle,
       ROUND(1.0 - SUM((y - p) ^ 2) / (VAR_POP(y) * COUNT(*)), 6) AS r2
FROM j GROUP BY dataset
""")
def m12_evaluate(spark, sf_dir):
    """Metrics per dataset of an hour-of-day mean baseline fitted on the first 80%."""
    h = views(spark, sf_dir).hourly.select("ts_hour", "hr", "cnt")
    s = R.fraction_split(h, "ts_hour", 0.2).drop("_pos")
    m = s.where(F.col("split") == "train").groupBy("hr").agg(F.avg("cnt").alias("p"))
    j = s.join(m, "hr").select(F.col("split").alias("dataset"), F.col("cnt").cast("double").alias("y"), "p")
    e = M.evaluate(j, "y", "p", "dataset")
    return e.select("dataset", *[F.round(c, 6).alias(c) for c in ("mse", "rmsle", "r2")])


def _grid_sql():
    g = M.grid_lists()

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, str):
            return f"'{v}'"
        return str(v)
    parts = [f"(SELECT unnest([{', '.join(lit(v) for v in vals)}]) AS {k})" for k, vals in g.items()]
    nf = (f"(SELECT {len(NUMERIC)} + COUNT(DISTINCT hr) + COUNT(DISTINCT weathersit) AS n_features "
          "FROM hourly) nf")
    return (f"""SELECT n_estimators, max_features, max_depth, min_samples_split, min_samples_leaf, bootstrap,
       CAST(CASE WHEN max_features = 'sqrt' THEN CEIL(SQRT(nf.n_features)) ELSE nf.n_features END AS INTEGER)
         AS features_per_split,
       CAST(LEAST(COALESCE(max_depth, {M.SPARK_MAX_DEPTH}), {M.SPARK_MAX_DEPTH}) AS INTEGER) AS spark_max_depth
FROM """ + ", ".join(parts) + ", " + nf)


@query("m13_param_grid", _grid_sql())
def m13_param_grid(spark, sf_dir):
    """The forest search grid (4,320 settings) as Spark settings for the hourly
    feature table: features tried per split (from the table's feature count,
    Spark's ``sqrt`` rounds up) and the depth after Spark's limit."""
    h = views(spark, sf_dir).hourly
    nf = h.agg((F.lit(len(NUMERIC)) + F.count_distinct("hr") + F.count_distinct("weathersit")).alias("_nf"))
    g = M.param_grid(spark, M.grid_lists()).crossJoin(F.broadcast(nf))
    return g.select(
        F.col("n_estimators").cast("int"), "max_features", F.col("max_depth").cast("int"),
        F.col("min_samples_split").cast("int"), F.col("min_samples_leaf").cast("int"), "bootstrap",
        F.when(F.col("max_features") == "sqrt", F.ceil(F.sqrt("_nf"))).otherwise(F.col("_nf"))
         .cast("int").alias("features_per_split"),
        F.least(F.coalesce("max_depth", F.lit(M.SPARK_MAX_DEPTH)), F.lit(M.SPARK_MAX_DEPTH))
         .cast("int").alias("spark_max_depth"))


@query("m14_random_search")
def m14_random_search(spark, sf_dir, lists=None, n_iter=100, folds=3):
    """``n_iter`` settings drawn from the grid of 4,320 with 3-fold cross-validation;
    one row for each setting with its mean MSE, and for the best one the errors of
    its refit on the training and validation rows."""
    tr, te, _ = _split(spark, sf_dir)
    settings = M.sample_settings(M.param_grid(spark, lists or M.grid_lists()), n_iter, SEED)
    results = FS.nested_search(tr, settings, folds, SEED, ["ts_hour"])
    least = min(r["mean_mse"] for r in results)
    best = next(s for s, r in zip(settings, results) if r["mean_mse"] == least)
    refit = FS.forest_scores(tr, {"training": tr, "validation": te}, best, SEED, ["ts_hour"])
    rows = [(int(s["n_estimators"]), s["max_features"], s["max_depth"], int(s["min_samples_split"]), int(s["min_samples_leaf"]), bool(s["bootstrap"]),
             s["mean_mse"], s["mean_mse"] == least, *((refit[d] if s["mean_mse"] == least else None) for d in ("training", "validation")))
            for s in results]
    return spark.createDataFrame(rows, "n_estimators int, max_features string, max_depth int, min_samples_split int, min_samples_leaf int, "
                                       "bootstrap boolean, mean_mse double, best boolean, training_mse double, validation_mse double")


@query("m15_importances")
def m15_importances(spark, sf_dir):
    tr, _, feats = _split(spark, sf_dir)
    return M.importances(spark, M.forest(300, seed=SEED).fit(tr), feats)


@query("m16_membership_ols")
def m16_membership_ols(spark, sf_dir):
    """Order value (thousands) on the brands an order contains, no intercept."""
    v = views(spark, sf_dir)
    b = baskets(v.order_products, v.products, item="aisle")
    o = Tables(spark, sf_dir).orders.select(F.col("o_orderkey").alias("order_id"),
                                              (F.col("o_totalprice") / 1000).alias("value"))
    model, names = M.membership_ols(b.join(o, "order_id"), "items", "value")
    return spark.createDataFrame([(n, float(c)) for n, c in zip(names, model.coefficients.toArray())],
                                 "member string, coef double")


@query("q11_net_train")
def q11_net_train(spark, sf_dir, iters=3500, batch=128, lr=0.7, hidden=15):
    """Seeded batch training of the one-hidden-layer net on the whole feature table
    (one-hot codes and standardized numbers); losses of every iteration (train and
    validation)."""
    h = views(spark, sf_dir).hourly.select("ts_hour", "cnt", "temp", "hum", "windspeed", "mday", "hr", "weathersit")
    z, _ = standardize(h, ["cnt", "temp", "hum", "windspeed"])
    wide = dummies(z, ["hr", "weathersit"])
    feats = [c for c in wide.columns if c not in ("ts_hour", "cnt", "mday")]
    d = wide.select("ts_hour", F.array(*[F.col(c).cast("double") for c in feats]).alias("x"), F.col("cnt").alias("y"))
    s = R.time_split(d, "ts_hour", 7 * 24, 10 * 24)
    rng = np.random.default_rng(SEED)
    w1 = rng.normal(0.0, len(feats) ** -0.5, (len(feats), hidden))
    w2 = rng.normal(0.0, hidden ** -0.5, (hidden, 1))
    losses, _, _ = N.net_train(s.where(F.col("split") == "train"), "x", "y", w1, w2, iters, batch, lr, SEED,
                               val=s.where(F.col("split") == "validation"), order=["ts_hour"])
    return losses


def _head_scores(spark, sf_dir, **options):
    """Held-out rows with class probabilities: the head fitted on four fifths of the
    vectors, by a hash of their id, and scored on the others."""
    e = M.holdout(Tables(spark, sf_dir).embeddings, 0.2, SEED, "vec_id")
    weights = N.train_head(e.where("split = 'train'"), "embedding", "label", 10, ["vec_id"], seed=SEED, **options)
    return N.score_head(e.where("split = 'test'").select("vec_id", "label", "embedding"), "embedding", weights)


@query("q13_train_head")
def q13_train_head(spark, sf_dir):
    """Classifier head (1,024 ReLU units and softmax, 200 epochs) on the frozen
    vectors, scored on the held-out ones."""
    d = _head_scores(spark, sf_dir)
    return d.select("vec_id", "label", argmax("probabilities").cast("int").alias("prediction"))


CLASS_NAMES = [f"class_{i}" for i in range(10)]


@query("q15_predict_labels")
def q15_predict_labels(spark, sf_dir, n=10):
    """Predict and name the class of a seeded sample of held-out rows."""
    p = M.predict_labels(_head_scores(spark, sf_dir), CLASS_NAMES, n, SEED, key="vec_id")
    return p.select("vec_id", "label", "predicted", "predicted_name")
