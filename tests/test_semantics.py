"""Goldens from the reference's own tests and the R / pandas semantics that
differ from Spark defaults, on small hand-made frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.functions import columns as C
from kiln.operators import models as M
from kiln.operators import network as N
from kiln.operators import profile as P
from kiln.operators import relational as R

# Reference network unit test -- fixed values --
X = [0.5, -0.2, 0.1]
Y = 0.4
W1 = [[0.1, -0.2], [0.4, 0.5], [-0.3, 0.2]]
W2 = [[0.3], [-0.1]]
RUN_GOLDEN = 0.09998924
W2_AFTER = [0.37275328, -0.03172939]
W1_AFTER = [[0.10562014, -0.20185996], [0.39775194, 0.50074398], [-0.29887597, 0.19962801]]


def test_sigmoid_half(spark):
    v = spark.range(1).select(C.sigmoid(F.lit(0.5)).alias("s")).first().s
    assert v == 1 / (1 + math.exp(-0.5))


def test_net_score_golden(spark):
    df = spark.createDataFrame([(X,)], "x array<double>")
    assert N.net_score(df, "x", W1, W2).first().score == pytest.approx(RUN_GOLDEN, abs=1e-8)


def test_net_step_golden(spark):
    df = spark.createDataFrame([(X, Y)], "x array<double>, y double")
    rows = N.net_step(df, "x", "y", W1, W2, 0.5).collect()
    got = {(r.layer, r.i, r.j): r.weight for r in rows}
    for i in range(3):
        for j in range(2):
            assert got[("input_hidden", i, j)] == pytest.approx(W1_AFTER[i][j], abs=1e-7)
    for j in range(2):
        assert got[("hidden_output", j, 0)] == pytest.approx(W2_AFTER[j], abs=1e-7)


def test_embedding_lookup_golden(spark):
    # 5 x 2 table of the reference's look-up example -- fixed values --
    table = [[0.5, 1.2], [-1.4, 0.7], [0.0, 0.0], [5.6, 9.8], [-2.3, -0.8]]
    t = spark.createDataFrame([(i, v) for i, v in enumerate(table)], "id long, embedding array<double>")
    ids = spark.createDataFrame([(k, i) for k, i in enumerate([3, 0, 4, 1])], "k long, id long")
    got = [r.embedding for r in R.embed(ids, t, "id").orderBy("k").collect()]
    assert got == [[5.6, 9.8], [0.5, 1.2], [-2.3, -0.8], [-1.4, 0.7]]


def test_membership_ols_golden(spark):
    # Membership rows of the reference's data file -- fixed values --
    rows = [("A", None, None, 1), ("B", None, None, 3), ("A", "B", None, 4), ("A", "B", "C", 9),
            ("C", "D", None, 13), ("B", "D", None, 11), ("A", "D", None, 6), ("A", "D", None, 10),
            ("A", "B", "D", 12)]
    df = spark.createDataFrame(rows, "m1 string, m2 string, m3 string, mean int").withColumn("mean", F.col("mean").cast("double"))
    model, names = M.membership_ols(df, ["m1", "m2", "m3"], "mean")
    coef = dict(zip(names, model.coefficients.toArray()))
    assert coef["A"] == pytest.approx(0.6585, abs=1e-4)
    assert coef["B"] == pytest.approx(3.3089, abs=1e-4)
    assert coef["C"] == pytest.approx(5.1951, abs=1e-4)
    assert coef["D"] == pytest.approx(7.6423, abs=1e-4)


def test_strict_aggregates_propagate_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    r = R.stats(df, ["v"]).first()
    assert r.v_mean is None and r.v_sd is None and r.v_median is None and r["count"] == 3
    r2 = R.stats(df, ["v"], na_rm=True).first()
    assert r2.v_mean == 2.0 and r2.v_median == 2.0


def test_paste0_na(spark):
    df = spark.createDataFrame([("F", None), (None, 30)], "g string, n int")
    assert [r.p for r in df.select(C.paste0("g", "n").alias("p")).collect()] == ["FNA", "NA30"]


def test_arrange_missing_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r.v for r in R.arrange(df, "v").collect()] == [1, 3, None]
    assert [r.v for r in R.arrange(df, "v", desc=("v",)).collect()] == [3, 1, None]


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate([5, 5, 5, 4, 3, None])], "id int, w int")
    assert sorted(r.id for r in R.top_n(df, 2, "w").collect()) == [0, 1, 2]
    assert sorted(r.id for r in R.top_n(df, 4, "w").collect()) == [0, 1, 2, 3]


def test_null_safe_join(spark):
    l = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    r = spark.createDataFrame([(None, "n"), ("a", "y")], "k string, y string")
    got = sorted((row.x, row.y) for row in R.left_join(l, r, "k", null_safe=True).collect())
    assert got == [(1, "n"), (2, "y")]
    plain = sorted((row.x, row.y) for row in R.left_join(l, r, "k").collect())
    assert plain == [(1, None), (2, "y")]


def test_natural_join_uses_shared_names(spark):
    l = spark.createDataFrame([(1, "x", 5)], "a int, b string, v int")
    r = spark.createDataFrame([(1, "x", 7), (1, "z", 8)], "a int, b string, w int")
    assert R.natural_left_join(l, r).collect()[0].w == 7


def test_flag_keeps_null(spark):
    df = spark.createDataFrame([("Red apple",), ("pear",), (None,)], "s string")
    got = [r.f for r in df.select(C.flag_contains("s", "red", "red", "other").alias("f")).collect()]
    assert got == ["red", "other", None]


def test_split_wide_ragged(spark):
    df = spark.createDataFrame([("a, b",), ("c",)], "s string")
    rows = C.split_wide(df, "s", ",", 3, prefix="p").orderBy("s").collect()
    assert (rows[0].p_1, rows[0].p_2, rows[0].p_3) == ("a", "b", None)
    assert (rows[1].p_1, rows[1].p_2) == ("c", None)


def test_fmt2_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-0.004,), (-1.235,), (None,)], "v double")
    got = [r.t for r in df.select(C.fmt2("v").alias("t")).collect()]
    assert got[1] == "2.50" and got[2] == "0.00" and got[4] is None
    assert got[3] in ("-1.24", "-1.23")


def test_dummies_names_and_missing(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    out = C.dummies(df, ["c"]).orderBy("id").collect()
    assert out[0].asDict() == {"id": 1, "c_a": 0, "c_b": 1}
    assert out[2].c_a == 0 and out[2].c_b == 0


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "x double")
    h = {r.bin: r.n for r in P.histograms(df, ["x"], 10).collect()}
    assert h[9] == 2 and sum(h.values()) == 11 and len(h) == 10


def test_pretty_breaks_known_values():
    assert P.pretty_breaks(1, 10, 5) == [0, 2, 4, 6, 8, 10]
    assert P.pretty_breaks(0, 100, 5) == [0, 20, 40, 60, 80, 100]
    assert P.pretty_breaks(0, 1, 5) == [0, 0.2, 0.4, 0.6, 0.8, 1.0]
    assert P.pretty_breaks(-3.2, 7.9, 4) == [-4, -2, 0, 2, 4, 6, 8]
    assert P.pretty_breaks(-3.2, 7.9, 3) == [-5, 0, 5, 10]
    assert P.pretty_breaks(17, 61, 7) == [15, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65]
    assert P.pretty_breaks(5, 5)[0] <= 5 <= P.pretty_breaks(5, 5)[-1] and len(P.pretty_breaks(0, 0)) == 2


def test_hist_pretty_right_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 3, 4, 10]], "x double")
    h = P.hist_pretty(df, "x").orderBy("bin").collect()
    assert h[0].lower == 0.0 and sum(r.n for r in h) == 6
    # 2 lies in (0, 2], not in (2, 4]
    assert h[0].n == 3


def test_percentile_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "v double")
    s = P.summary6(df, ["v"]).first()
    assert s.q1 == 1.75 and s.median == 3.0


def test_softmax_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 0.0],)], "a array<double>")
    r = A.with_softmax(df, "a", "p").select("p", A.argmax("a").alias("k")).first()
    e = np.exp(np.array([1.0, 3.0, 3.0, 0.0]) - 3.0)
    assert np.allclose(r.p, e / e.sum()) and r.k == 1


def _cd_enet(X, y, alpha, rho, iters=5000):
    Xc, yc = X - X.mean(0), y - y.mean()
    n, p = Xc.shape
    w = np.zeros(p)
    for _ in range(iters):
        for j in range(p):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            z = Xc[:, j] @ r / n
            w[j] = np.sign(z) * max(abs(z) - alpha * rho, 0) / (Xc[:, j] @ Xc[:, j] / n + alpha * (1 - rho))
    return w


@pytest.fixture(scope="module")
def linear_data(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 3)) * [1.0, 2.0, 0.5]
    y = X @ [1.5, -0.7, 3.0] + 2.0 + rng.normal(scale=0.8, size=200)
    df = spark.createDataFrame([(x.tolist(), float(t)) for x, t in zip(X, y)], "x array<double>, label double")
    from pyspark.ml.functions import array_to_vector
    return X, y, df.select(array_to_vector("x").alias("features"), "label")


def test_ridge_matches_closed_form(linear_data):
    X, y, df = linear_data
    sd, n = M.label_stats(df, "label")
    w = M.ridge(0.5 * n, sd, n).fit(df).coefficients.toArray()
    Xc, yc = X - X.mean(0), y - y.mean()
    expect = np.linalg.solve(Xc.T @ Xc + 0.5 * n * np.eye(3), Xc.T @ yc)
    assert np.allclose(w, expect, atol=1e-4)


def test_lasso_matches_coordinate_descent(linear_data):
    X, y, df = linear_data
    w = M.lasso(0.3).fit(df).coefficients.toArray()
    assert np.allclose(w, _cd_enet(X, y, 0.3, 1.0), atol=1e-3)


def test_enet_matches_coordinate_descent(linear_data):
    X, y, df = linear_data
    sd, _ = M.label_stats(df, "label")
    w = M.enet(1.0, 0.5, sd).fit(df).coefficients.toArray()
    assert np.allclose(w, _cd_enet(X, y, 1.0, 0.5), atol=1e-3)


@pytest.mark.parametrize("n, lanes, steps, epochs", [(101, 4, 3, 1), (101, 4, 3, 3), (53, 3, 2, 5), (30, 7, 2, 2), (5, 4, 3, 2)])
def test_lane_batches_wrap_past_the_end(spark, n, lanes, steps, epochs):
    """Against the loop over a running time index."""
    from kiln.operators import sequence as S
    ids = [i * 3 for i in range(n)]
    size = n - 1
    jump, iters = size // lanes, size // (lanes * steps)
    want, k = [], 0
    for epoch in range(epochs):
        for it in range(iters):
            for step in range(steps):
                for lane in range(lanes):
                    p = (lane * jump + k) % size
                    want.append((epoch, it, lane, step, ids[p], ids[p + 1]))
                k += 1
    corpus = spark.createDataFrame([(i, ids[i], ids[i + 1] if i < size else None) for i in range(n)], "gpos long, token_id long, next_id long")
    assert sorted(tuple(r) for r in S.lane_batches(corpus, lanes, steps, epochs).collect()) == sorted(want)
