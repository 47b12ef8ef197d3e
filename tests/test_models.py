"""Fitted models: trees against their own node tables, forests and searches by
what must hold for any fit."""

import itertools
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import forest_search as FS
from kiln.operators.tree import prune, reg_tree
from kiln.plans import all_queries, modelling


def test_tree_leaves_are_means_of_their_rows(spark, sf):
    d, tree = modelling.receipt_tree(spark, sf)
    leaves = {i: n for i, n in tree.nodes.items() if n["feature"] is None}
    assert len(leaves) > 2
    own = tree.predict(d).groupBy("leaf").agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n")).collect()
    assert {r.leaf for r in own} == set(leaves)
    for r in own:
        assert r.n == leaves[r.leaf]["n"] and float(r.mean) == pytest.approx(leaves[r.leaf]["prediction"], rel=1e-6)


def test_pruning_weighs_a_split_by_its_rows():
    nodes = {1: {"error": 1000.0, "feature": "x"}, 2: {"error": 180.0, "feature": None}, 3: {"error": 50.0, "feature": "x"},
             6: {"error": 22.0, "feature": None}, 7: {"error": 22.0, "feature": None}}
    assert sorted(prune(nodes, 10.0)) == [1, 2, 3] and sorted(prune(nodes, 4.0)) == [1, 2, 3, 6, 7] and sorted(prune(nodes, 900.0)) == [1]
    assert sorted(prune(nodes, 6.0)) == [1, 2, 3]  # what a split saves only equals its cost


def plain_tree(rows, kinds, max_depth, min_split, min_leaf, cp):
    """Grown and pruned tree of (features..., y) rows: number of a node -> (rows, feature, cut or levels on the left)."""
    def error(part):
        return sum(r[-1] ** 2 for r in part) - sum(r[-1] for r in part) ** 2 / len(part)
    floor = cp * error(rows)

    def grow(part, i):
        """(cost, nodes) of the best pruned subtree."""
        alone = error(part) + floor, {i: (len(part), None, None)}
        best = None
        if len(part) >= min_split and error(part) > floor and i.bit_length() <= max_depth:
            for f, kind in enumerate(kinds):
                known = [r for r in part if r[f] is not None]
                groups = {}
                for r in known:
                    groups.setdefault(r[f], []).append(r[-1])
                order = sorted(groups, key=lambda v: (sum(groups[v]) / len(groups[v]), v) if kind == "text" else v)
                total, nl, sl = sum(r[-1] for r in known), 0, 0
                for k, v in enumerate(order[:-1]):
                    nl, sl = nl + len(groups[v]), sl + sum(groups[v])
                    nr = len(known) - nl
                    if nl >= min_leaf and nr >= min_leaf:
                        gain = Fraction(sl * sl, nl) + Fraction((total - sl) ** 2, nr) - Fraction(total * total, len(known))
                        if gain > 0 and (best is None or gain > best[0]):
                            best = gain, f, set(order[:k + 1]), (v, order[k + 1]), nl, nr
        if best is None:
            return alone
        _, f, left, cut, nl, nr = best
        side = [r for r in part if r[f] in left or r[f] is None and nl >= nr], [r for r in part if r[f] is not None and r[f] not in left or r[f] is None and nl < nr]
        (cl, tl), (cr, tr) = grow(side[0], 2 * i), grow(side[1], 2 * i + 1)
        if cl + cr >= alone[0]:
            return alone
        return cl + cr, {i: (len(part), f, sorted(left) if kinds[f] == "text" else sum(cut) / 2)} | tl | tr
    return grow(rows, 1)[1]


@pytest.mark.parametrize("part_rows", [0, 60, 1000])
@pytest.mark.parametrize("seed, limits", [(1, (30, 20, 7, 0.01)), (2, (30, 2, 1, 0.01)), (3, (2, 6, 2, 0.0))])
def test_tree_equals_a_plain_one(spark, seed, limits, part_rows):
    rng = random.Random(seed)
    rows = []
    for _ in range(160):
        a, b, c = rng.choice([None, *range(12)]), rng.randrange(1000) / 8, rng.choice([None, "p", "q", "r", "s", "ü"])
        rows.append((a, b, c, (a or 3) * 5 + int(b > 60) * 40 + {"p": 9, "s": 20}.get(c, 0) + rng.randrange(8)))
    df = spark.createDataFrame(rows, "a int, b double, c string, y long").repartition(5)
    depth, min_split, min_leaf, cp = limits
    if seed == 2:
        df = df.withColumn("y", F.col("y").cast("decimal(12,2)"))
    tree = reg_tree(df, "y", max_depth=depth, min_split=min_split, min_leaf=min_leaf, cp=cp, part_rows=part_rows)
    want = plain_tree(rows, ["number", "number", "text"], depth, min_split, min_leaf, cp)
    got = {i: (n["n"], None if n["feature"] is None else "abc".index(n["feature"]), n["categories"] or n["threshold"]) for i, n in tree.nodes.items()}
    assert got == want and len(got) > 3
    leaves = {r.leaf: r["count"] for r in tree.predict(df).groupBy("leaf").count().collect()}
    assert leaves == {i: n for i, (n, f, _) in want.items() if f is None}


@pytest.mark.parametrize("kind", ["long", "double", "decimal(12,2)"])
def test_tree_is_the_same_for_any_bins(spark, kind):
    """A cut within a bin of many values is found like one between bins, and as by counting each value."""
    rng = random.Random(5)
    rows = [(rng.randrange(400), rng.choice([None, *(k / 4 for k in range(300))]), rng.choice([None, "p", "q", "r"])) for _ in range(700)]
    rows = [(*r, (r[0] % 190) // 3 + int((r[1] or 20) > 33.3) * 30 + {"p": 4}.get(r[2], 0) + rng.randrange(5)) for r in rows]
    df = spark.createDataFrame(rows, "a int, b double, c string, y long").withColumn("y", F.col("y").cast(kind)).repartition(3)
    one, many, counted = (reg_tree(df, "y", part_rows=50, **o).nodes for o in ({"n_bins": 3}, {}, {"most_levels": 0}))
    assert len(one) > 9 and one.keys() == many.keys() == counted.keys()
    for i, n in counted.items():
        for other in (one[i], many[i]):
            assert all(other[c] == n[c] for c in ("n", "feature", "threshold", "categories", "major"))
            assert abs(other["error"] - n["error"]) < 1e-6


def test_tree_cuts_exactly_and_keeps_small_nodes(spark):
    step = spark.range(10000).select(F.col("id").alias("x"), (F.col("id") > 4320).cast("double").alias("y"))
    nodes = reg_tree(step, "y").nodes
    assert (nodes[1]["threshold"], nodes[2]["n"], sorted(nodes)) == (4320.5, 4321, [1, 2, 3])
    assert len(reg_tree(step.where("x < 19").withColumn("y", (F.col("x") > 8).cast("double")), "y").nodes) == 1
    assert len(reg_tree(step.where("x < 20").withColumn("y", (F.col("x") > 8).cast("double")), "y").nodes) == 3


def test_tree_takes_dates_and_many_levels(spark):
    df = spark.range(400).select(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("day"),
                                 F.concat(F.lit("level"), F.col("id") % 90).alias("name"), (F.col("id") % 300 >= 150).cast("double").alias("y"))
    tree = reg_tree(df, "y")
    assert tree.nodes[1]["feature"] == "day" and tree.nodes[1]["threshold"] == 18262 + 149.5 and tree.predict(df).where("y != prediction").count() == 0
    # a level that the tree has not seen, and a missing one, go with the larger side
    named = reg_tree(df.withColumn("y", F.col("name").isin("level3", "level7").cast("double")).drop("day"), "y")
    unseen = spark.createDataFrame([("other",), (None,), ("level7",)], "name string")
    assert [r.prediction for r in named.predict(unseen).collect()] == [0.0, 0.0, 1.0]


def test_tree_of_nothing(spark):
    empty = spark.createDataFrame([], "x int, y double")
    tree = reg_tree(empty, "y")
    assert tree.nodes[1]["n"] == 0 and tree.predict(empty).count() == 0
    assert len(reg_tree(spark.createDataFrame([(1, None), (2, 5.0)], "x int, y double"), "y").nodes) == 1


@pytest.mark.parametrize("name", ["m6_forest", "m7_bagged_trees", "m8_boosted"])
def test_predictions_beat_the_mean(spark, sf, name):
    rows = all_queries()[name](spark, sf).collect()
    ys = [r.cnt for r in rows]
    mean = sum(ys) / len(ys)
    assert len(rows) > 10 and all(r.prediction is not None for r in rows)
    assert sum((r.cnt - r.prediction) ** 2 for r in rows) < 1.5 * sum((y - mean) ** 2 for y in ys)


def test_leaderboard_has_both_sets_of_every_model(spark, sf):
    rows = all_queries()["m11_leaderboard"](spark, sf).collect()
    assert len({(r.model, r.dataset) for r in rows}) == len(rows) == 26 and all(r.mse >= 0 for r in rows)


def plain_forest_tree(x, y, w, min_leaf, depth, least):
    """Prediction function of a weighted tree on every feature, cut off by depth and least rows."""
    def grow(rows, d):
        mean = sum(w[i] * y[i] for i in rows) / sum(w[i] for i in rows)
        best = None
        if len(rows) >= least and (depth is None or d < depth):
            def score(part):
                return sum(w[i] * y[i] for i in part) ** 2 / sum(w[i] for i in part)
            for f in range(len(x[0])):
                values = sorted({x[i][f] for i in rows})
                for a, b in zip(values, values[1:]):
                    left, right = [i for i in rows if x[i][f] <= a], [i for i in rows if x[i][f] > a]
                    gain = score(left) + score(right) - score(rows)
                    if min(len(left), len(right)) >= min_leaf and gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, f, (a + b) / 2, left, right
        if best is None:
            return lambda v: mean
        _, f, cut, left, right = best
        sons = grow(left, d + 1), grow(right, d + 1)
        return lambda v: sons[0 if v[f] <= cut else 1](v)
    return grow([i for i in range(len(y)) if w[i]], 0)


@pytest.mark.parametrize("min_leaf", [1, 3])
def test_cut_off_trees_equal_trees_grown_so(min_leaf):
    rng = np.random.default_rng(min_leaf)
    x, y = np.column_stack([rng.random(60), rng.integers(0, 3, 60), rng.random(60)]), rng.random(60) * 10
    w = np.bincount(rng.integers(0, 60, 60), minlength=60).astype(float)
    tree = FS.grow_tree(x, y, np.argsort(x, axis=0, kind="stable").T, w, 3, min_leaf, rng)
    depths, leasts = [0, 1, 3, None], [2, 5, 10]
    got = FS.cut_predictions(tree, x, depths, leasts)
    for i, d in enumerate(depths):
        for k, m in enumerate(leasts):
            plain = plain_forest_tree(x.tolist(), y.tolist(), w.tolist(), min_leaf, d, m)
            assert got[i, k] == pytest.approx([plain(v) for v in x.tolist()])


def test_nested_search_equals_a_forest_for_each_setting(spark):
    rng = np.random.default_rng(8)
    x, y = np.column_stack([rng.random((50, 3)), rng.integers(0, 2, 50)]), rng.random(50)
    df = spark.createDataFrame([(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, features array<double>, label double").repartition(3)
    lists = {"n_estimators": [2, 4], "max_features": ["auto", "sqrt"], "max_depth": [2, None], "min_samples_split": [2, 9], "min_samples_leaf": [1, 3], "bootstrap": [True, False]}
    settings = [dict(zip(lists, v)) for v in itertools.product(*lists.values())]
    got = FS.nested_search(df, settings, 3, 5, block=2)
    fold = np.array([r[0] for r in df.orderBy("id").select(F.pmod(F.xxhash64("id"), F.lit(3))).collect()])
    kinds = list(dict.fromkeys((s["max_features"], s["min_samples_leaf"], s["bootstrap"]) for s in settings))
    for s in got:
        k, errors = kinds.index((s["max_features"], s["min_samples_leaf"], s["bootstrap"])), []
        for p in range(3):
            fit, held, total = fold != p, fold == p, 0
            for t in range(s["n_estimators"]):
                draw = np.random.default_rng([5, k, p, t // 2, t % 2])
                n = int(fit.sum())
                w = np.bincount(draw.integers(0, n, n), minlength=n).astype(float) if s["bootstrap"] else np.ones(n)
                tree = FS.grow_tree(x[fit], y[fit], np.argsort(x[fit], axis=0, kind="stable").T, w, 4 if s["max_features"] == "auto" else 2, s["min_samples_leaf"], draw)
                total = total + FS.cut_predictions(tree, x[held], [s["max_depth"]], [s["min_samples_split"]])[0, 0]
            errors.append(np.mean((y[held] - total / s["n_estimators"]) ** 2))
        assert s["mean_mse"] == pytest.approx(np.mean(errors))
    assert len({r["mean_mse"] for r in got}) > 30


def test_search_refits_the_best_setting(spark, sf):
    small = {"n_estimators": [200, 400], "max_features": ["sqrt"], "max_depth": [2, 20], "min_samples_split": [2], "min_samples_leaf": [4], "bootstrap": [True]}
    rows = modelling.m14_random_search(spark, sf, small, 3).collect()
    best = [r for r in rows if r.best]
    assert len(rows) == 3 and best[0].mean_mse == min(r.mean_mse for r in rows)
    assert 0 <= best[0].training_mse < best[0].mean_mse and best[0].validation_mse >= 0


def test_head_is_scored_on_held_out_rows(spark, sf):
    rows = all_queries()["q13_train_head"](spark, sf).collect()
    n = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert 0 < len(rows) < n / 2 and all(0 <= r.prediction < 10 for r in rows)
    named = all_queries()["q15_predict_labels"](spark, sf).collect()
    assert len(named) == 10 and all(r.predicted_name == f"class_{r.predicted}" for r in named)


def test_training_lowers_the_loss(spark, sf):
    rows = sorted(all_queries()["q11_net_train"](spark, sf).collect())
    assert len(rows) == 3500 and rows[-1].train_loss < rows[0].train_loss / 2


def test_importances_sum_to_one(spark, sf):
    rows = all_queries()["m15_importances"](spark, sf).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1.0) and [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, len(rows) + 1))


def test_head_step_meets_the_first_layer_once():
    """A step took the product of its rows and the first layer twice."""
    import numpy as np
    from kiln.operators.network import epoch_picks, head_start, head_step
    products = []

    class Rows(np.ndarray):
        def __matmul__(self, other):
            products.append(other.shape)
            return np.asarray(self) @ other
    rng = np.random.default_rng(1)
    batch, state = np.column_stack([rng.normal(size=(9, 4)), rng.integers(0, 3, 9)]), head_start(4, 6, 3, 2)
    for v in state[4:]:
        v += rng.normal(size=v.shape)
    before = [s.copy() for s in state]
    got = head_step(state, batch.view(Rows), 0.1, 0.9)
    assert products.count((4, 6)) == 1 and all((a == b).all() for a, b in zip(before, state))
    w1, b1, w2, b2, *v = state
    x, y = batch[:, :-1], np.eye(3)[batch[:, -1].astype(int)]
    z = x @ w1 + b1
    e = np.exp(np.maximum(z, 0) @ w2 + b2)
    d = (e / e.sum(1, keepdims=True) - y) / 9
    back = (d @ w2.T) * (z > 0)
    for a, s, u, g in zip(got[:4], state, v, (x.T @ back, back.sum(0), np.maximum(z, 0).T @ d, d.sum(0))):
        assert np.allclose(a, s + 0.9 * u - 0.1 * g)
    assert [p.tolist() for p in epoch_picks(7, 1, 3, 4)] != [] and sorted(np.concatenate(list(epoch_picks(7, 1, 3, 4)))) == list(range(7))


def test_few_rows_are_passed_over_in_few_tasks(spark):
    """A pass over some hundred rows took a task for each partition of the table."""
    from kiln.operators.kernel import gathered
    rows = spark.range(700).repartition(40)
    few, many = gathered(rows), gathered(rows, 50)
    assert few.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() == 14
    assert sorted(r.id for r in few.collect()) == sorted(r.id for r in many.collect()) == list(range(700))
    assert gathered(spark.range(0)).count() == 0
    few.unpersist(), many.unpersist()
