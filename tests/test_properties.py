"""Property tests: splits complete and disjoint, positions contiguous, shares
sum to one, round trips, sample sizes, pruning and importances."""

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kiln.functions import columns as C
from kiln.operators import basket as B
from kiln.operators import models as M
from kiln.operators import relational as R
from kiln.operators.indexing import dense_index, prefix_sum, row_index
from kiln.sources.views import views


def test_row_index_contiguous_on_shuffled_input(spark):
    rows = [(random.Random(i).random(), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "v double, id int").repartition(7).groupBy("id").agg(F.max("v").alias("v"))
    out = row_index(df, ["v", "id"], name="pos", start=1).collect()
    pos = sorted(r.pos for r in out)
    assert pos == list(range(1, 5001))
    by_pos = sorted(out, key=lambda r: r.pos)
    assert [(r.v, r.id) for r in by_pos] == sorted((r.v, r.id) for r in out)


def test_row_index_survives_column_pruning(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") * 7 % 101).alias("k"), F.lit("x").alias("pad"))
    idx = row_index(df.repartition(5), ["k", "id"], name="pos")
    assert sorted(r.pos for r in idx.select("pos").collect()) == list(range(3000))


def test_dense_index_and_prefix_sum(spark):
    df = spark.createDataFrame([(c,) for c in "dbadcab"], "c string")
    assert {r.c: r.level for r in dense_index(df, "c").collect()} == {"a": 1, "b": 2, "c": 3, "d": 4}
    w = spark.createDataFrame([(i, i % 3 + 1) for i in range(100)], "k int, w int")
    got = {r.k: r.offset for r in prefix_sum(w, "k", "w").collect()}
    acc = 0
    for k in range(100):
        assert got[k] == acc
        acc += k % 3 + 1


def test_holdout_disjoint_complete_and_stable(spark, sf):
    h = views(spark, sf).hourly.select("ts_hour")
    a = M.holdout(h, 0.2, 42, "ts_hour")
    b = M.holdout(h.repartition(3), 0.2, 42, "ts_hour")
    ra = {r.ts_hour: r.split for r in a.collect()}
    rb = {r.ts_hour: r.split for r in b.collect()}
    assert ra == rb and len(ra) == h.count()
    share = sum(v == "test" for v in ra.values()) / len(ra)
    assert 0.1 < share < 0.3


def test_time_and_fraction_split(spark, sf):
    h = views(spark, sf).hourly.select("ts_hour")
    n = h.count()
    t = R.time_split(h, "ts_hour", 24, 48).groupBy("split").count().collect()
    c = {r.split: r["count"] for r in t}
    assert c["test"] == 24 and c["validation"] == 48 and c["train"] == n - 72
    f = {r.split: r["count"] for r in R.fraction_split(h, "ts_hour", 0.2).groupBy("split").count().collect()}
    assert f["train"] == int(n * 0.8) and f["train"] + f["test"] == n
    latest_train = R.fraction_split(h, "ts_hour", 0.2).where("split = 'train'").agg(F.max("ts_hour")).first()[0]
    earliest_test = R.fraction_split(h, "ts_hour", 0.2).where("split = 'test'").agg(F.min("ts_hour")).first()[0]
    assert latest_train < earliest_test


def test_standardize_round_trip(spark, sf):
    h = views(spark, sf).hourly.select("ts_hour", "temp")
    z, st = C.standardize(h, ["temp"])
    zs = z.agg(F.avg("temp"), F.stddev_samp("temp")).first()
    assert abs(zs[0]) < 1e-9 and abs(zs[1] - 1) < 1e-9
    back = C.unstandardize(z, "temp", st).join(h.withColumnRenamed("temp", "t0"), "ts_hour")
    assert back.where(F.abs(F.col("temp") - F.col("t0")) > 1e-9).count() == 0


def test_shares_sum_to_one(spark, sf):
    o = views(spark, sf).order_products
    s = R.share(R.count_by(o, "reordered"), "count").agg(F.sum("proportion")).first()[0]
    assert s == pytest.approx(1.0)
    w = R.share(R.count_by(o, ["product_id", "add_to_cart_order"]), "count", by="product_id", name="pct")
    bad = w.groupBy("product_id").agg(F.sum("pct").alias("s")).where(F.abs(F.col("s") - 1) > 1e-9).count()
    assert bad == 0


def test_samples(spark, sf):
    p = views(spark, sf).products
    s1 = R.sample_n(p, 10, seed=3, key="product_id")
    assert s1.count() == 10 and s1.select("product_id").distinct().count() == 10
    s2 = R.sample_n(p.select("product_id"), 50, seed=3, replace=True, order="product_id")
    assert s2.count() == 50
    assert s2.join(p, "product_id", "left_anti").count() == 0


def test_pruned_rules_subset_and_no_contained_pairs(spark, sf):
    v = views(spark, sf)
    b = B.baskets(v.order_products, v.products, item="aisle")
    m = B.fit(b, 0.01, 0.1)
    r = B.rules(b, 0.01, 0.1, model=m)
    pr = B.prune_rules(r)
    assert pr.join(r, ["lhs", "rhs"], "left_anti").count() == 0
    rows = sorted(pr.collect(), key=lambda x: (-x.lift, x.lhs, x.rhs))
    sets = [set(x.antecedent) | set(x.consequent) for x in rows]
    for j in range(len(sets)):
        assert not any(sets[i] <= sets[j] for i in range(j))


def test_short_rule_prunes_longer_ones(spark):
    """{a} => {b} lifts most, so the longer rules on a and b say nothing new."""
    txns = [["a", "b", "c"]] * 4 + [["a", "b"]] * 8 + [["a", "c"]] * 3 + [["c"]] * 8 + [["d", "e", "f", "g"]] * 4
    b = spark.createDataFrame([(i, t) for i, t in enumerate(txns)], "order_id int, items array<string>")
    r = B.rules(b, 0.1, 0.3)
    kept = [(set(x.antecedent) | set(x.consequent)) for x in B.prune_rules(r).collect()]
    assert {"a", "b"} in kept and {"a", "b", "c"} not in kept
    assert {3, 4} <= {len(x.antecedent) + 1 for x in r.collect()}


def test_rules_table_keeps_every_item(spark):
    b = spark.createDataFrame([(i, t) for i, t in enumerate([["a", "b", "c", "d"]] * 3 + [["x"]] * 3)], "order_id int, items array<string>")
    r = B.rules(b, 0.1, 0.1, 3)
    rows = B.rules_table(r).collect()
    whole = [x for x in rows if x.rules == "{a,b,d} => {c}"]
    assert [(x.LHS_1, x.LHS_2, x.LHS_3, x.RHS) for x in whole] == [("a", "b", "d", "c")]
    with pytest.raises(ValueError):
        B.rules_table(r, 2)


def test_missing_groups_are_groups(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 3.0), (3, None, 1.0)], "id int, g string, v double")
    assert sorted(R.share(df, "v", by="g").select("id", "proportion").collect()) == [(1, 1.0), (2, 0.75), (3, 0.25)]
    assert sorted(R.number_within(df, "g", "id").select("id", "row_number").collect()) == [(1, 1), (2, 1), (3, 2)]


def test_time_split_counts_rows_through_ties(spark):
    df = spark.range(40).selectExpr("id", "id div 4 AS t")
    got = {r["split"]: r["count"] for r in R.time_split(df, "t", 6, 6, tiebreak="id").groupBy("split").count().collect()}
    assert got == {"test": 6, "validation": 6, "train": 28}


def test_rules_lhs_of_any_length_and_consequent_single(spark):
    txns = [["a", "b", "c"]] * 8 + [["a", "b"]] * 2 + [["c"]] * 5
    b = spark.createDataFrame([(i, t) for i, t in enumerate(txns)], "order_id int, items array<string>")
    r = B.rules(b, 0.1, 0.8, min_len=3)
    got = {(x.lhs, x.rhs): round(x.confidence, 6) for x in r.collect()}
    assert got[("{a,b}", "{c}")] == 0.8
    assert all(x.length >= 3 for x in r.collect())
    rf = B.rules_for(b, "c", 0.1, 0.5)
    assert ("{}", "{c}") in {(x.lhs, x.rhs) for x in rf.collect()}


def test_importances_sum_to_one(spark, sf):
    from kiln.plans.modelling import _split
    tr, _, feats = _split(spark, sf)
    imp = M.importances(spark, M.forest(10, 5, seed=1).fit(tr), feats).collect()
    assert sum(r.importance for r in imp) == pytest.approx(1.0)
    assert sorted(r["rank"] for r in imp) == list(range(1, len(imp) + 1))


def test_number_within_matches_window_on_hot_key(spark):
    from pyspark.sql import Window
    rows = [(0 if i % 3 else i % 17, (i * 7919) % 1000, i) for i in range(3000)]  # key 0 holds 2/3
    df = spark.createDataFrame(rows, "k int, t int, id int")
    got = R.number_within(df, "k", ["t", "id"], name="rn", lag={"t": "prev_t"})
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = df.select("id", F.row_number().over(w).alias("rn"), F.lag("t").over(w).alias("prev_t"))
    assert got.select("id", "rn", "prev_t").exceptAll(exp).count() == 0
    assert got.count() == 3000


def test_next_pairs_equals_lead(spark):
    from pyspark.sql import Window
    rows = [(d, p, f"w{(d * 31 + p * 7) % 13}") for d in range(5) for p in range(d * 40 + 1)]
    df = spark.createDataFrame(rows, "doc int, pos int, tok string")
    got = R.next_pairs(df, "doc", "pos", "tok", name="nxt").select("doc", "pos", "tok", "nxt")
    w = Window.partitionBy("doc").orderBy("pos")
    exp = df.withColumn("nxt", F.lead("tok").over(w)).where(F.col("nxt").isNotNull())
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_quantiles_match_numpy_with_ties_and_nulls(spark):
    import numpy as np
    from kiln.operators.indexing import quantiles
    rng = np.random.default_rng(5)
    a = rng.integers(0, 20, 777).astype(float)
    b = rng.normal(size=777)
    rows = [(float(x), None if i % 11 == 0 else float(y)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.column, r.p): r.value for r in quantiles(df, ["a", "b"], probs).collect()}
    bb = np.array([y for _, y in rows if y is not None])
    for p in probs:
        assert got[("a", p)] == pytest.approx(np.quantile(a, p), abs=1e-12)
        assert got[("b", p)] == pytest.approx(np.quantile(bb, p), abs=1e-12)


def test_spread_deals_a_small_scan_to_all_cores(spark, sf):
    from kiln.session import spread
    from kiln.sources.tables import Tables
    docs = Tables(spark, sf).documents.select("doc_id", "text")
    s = spread(docs)
    assert s.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert s.count() == docs.count()
    many = docs.repartition(4 * spark.sparkContext.defaultParallelism)
    assert spread(many) is many


def test_row_index_stable_across_recomputation(spark):
    # input whose content changes on every evaluation: the index must not
    src = spark.range(2000).select("id", F.rand().alias("r")).repartition(6)
    idx = row_index(src, ["r", "id"], name="pos")
    a = sorted((r.id, r.pos) for r in idx.collect())
    b = sorted((r.id, r.pos) for r in idx.select("id", "pos").collect())
    assert a == b
    assert sorted(p for _, p in a) == list(range(2000))


def test_approximate_profiles_close_to_exact(spark, sf):
    from kiln.operators import profile as P
    from kiln.sources.tables import Tables
    li = Tables(spark, sf).lineitem
    ex = {r.column: r for r in P.summary6(li, ["l_quantity", "l_extendedprice"]).collect()}
    ap = {r.column: r for r in P.summary6(li, ["l_quantity", "l_extendedprice"], exact=False).collect()}
    for c in ex:
        assert ap[c].min == ex[c].min and ap[c].max == ex[c].max
        spread_ = ex[c].max - ex[c].min
        for k in ("q1", "median", "q3"):
            assert abs(ap[c][k] - ex[c][k]) <= 0.01 * spread_
    sk = {r.skim_variable: r for r in P.skim(Tables(spark, sf).customer, exact=False, approx_distinct=True).collect()}
    assert sk["c_acctbal"].p0 is not None and sk["c_name"].n_unique > 0


def test_numbering_of_null_and_spread_keys(spark):
    """One customer with nine tenths of the rows over many partitions, and rows
    without a customer, against a window."""
    from pyspark.sql import Window
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 10 < 8 THEN 7 WHEN id % 10 = 8 THEN id % 50 END AS k", "(id * 7919) % 3001 AS t")
    w = Window.partitionBy("k").orderBy("t", "id")
    want = sorted(df.select("id", F.row_number().over(w).alias("rn"), F.lag("t").over(w).alias("p")).collect())
    got = R.number_within(df, "k", ["t", "id"], name="rn", lag={"t": "p"}).select("id", "rn", "p").collect()
    assert sorted(got) == want


def test_quantiles_of_hot_values(spark):
    import numpy as np
    from kiln.operators.indexing import quantiles
    xs = [5.0] * 700 + [float(i) for i in range(201)] + [None] * 20
    df = spark.createDataFrame([(x, 1.0 if x else None) for x in xs], "x double, y double")
    got = {(r["column"], r.p): r.value for r in quantiles(df, ["x", "y"], [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
    own = [x for x in xs if x is not None]
    assert all(abs(got[("x", p)] - np.quantile(own, p)) < 1e-9 and got[("y", p)] == 1.0 for p in (0.0, 0.1, 0.5, 0.9, 1.0))


def test_item_sets_grow_from_different_baskets(spark):
    """FP-growth went through every basket, however many were equal."""
    rng = random.Random(5)
    some = [sorted(rng.sample("abcdefgh", rng.randint(0, 6))) for _ in range(30)]
    txns = [rng.choice(some) for _ in range(600)] + [None]
    b = spark.createDataFrame(list(enumerate(txns)), "order_id int, items array<string>")
    each = {tuple(r["items"]): r.n for r in B.counted_baskets(b).where("items IS NOT NULL").collect()}
    assert each == Counter(tuple(t) for t in txns if t is not None)
    least = math.ceil(0.05 * 600)
    plain = Counter(s for t in txns if t is not None for k in range(1, 7) for s in itertools.combinations(t, k))
    want = {s: n for s, n in plain.items() if n >= least}
    assert max(map(len, want)) > 3
    for small in (0, 1000):
        m = B.fit(b, 0.05, 0.4, small=small)
        assert {tuple(r["items"]): r.freq for r in m.freqItemsets.collect()} == want
    rules = {(tuple(sorted(r.antecedent)), r.consequent[0]): (r.confidence, r.lift, r.support) for r in m.associationRules.collect()}
    expected = {}
    for s, n in want.items():
        for c in s if len(s) > 1 else ():
            left = tuple(x for x in s if x != c)
            if n / want[left] >= 0.4:
                expected[left, c] = pytest.approx((n / want[left], n / want[left] / (want[c,] / 600), n / 600))
    assert rules == expected
    with pytest.raises(Exception, match="unique"):
        B.fit(spark.createDataFrame([(1, ["a", "a"])], "order_id int, items array<string>"))
