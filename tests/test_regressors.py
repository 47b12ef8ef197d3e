"""The comparison's own regressors against plain versions on small tables."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators.kernel import SupportRegressor, gaussian
from kiln.operators.neighbours import NeighbourBag, _poisson, draws
from kiln.operators.sgd import SgdRegressor, descend


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3))
    y = np.round(3 * np.sin(x[:, 0]) + x[:, 1] + 0.3 * rng.normal(size=60), 3)
    df = spark.createDataFrame([(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, features array<double>, label double").repartition(3)
    return df, x, y


def predictions(model, df):
    return np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])


def least_loss(k, y, c, epsilon, rounds=20_000):
    """The least of |w|^2 / 2 + c x losses for kernel matrix k, by subgradient steps on its square root."""
    value, vector = np.linalg.eigh(k)
    f = np.column_stack([vector * np.sqrt(np.maximum(value, 0)), np.ones(len(y))])
    w, best = np.zeros(f.shape[1]), math.inf
    for t in range(1, rounds):
        e = y - f @ w
        best = min(best, 0.5 * (w[:-1] ** 2).sum() + c * np.maximum(0, np.abs(e) - epsilon).sum())
        g = np.append(w[:-1], 0.0) - c * f.T @ (np.sign(e) * (np.abs(e) > epsilon))
        w = w - 0.3 / math.sqrt(t) * g / max(1.0, np.linalg.norm(g))
    return best


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_support_regression_reaches_the_least_loss(small, kernel):
    df, x, y = small
    model = SupportRegressor(kernel, c=2.0, epsilon=0.2, landmarks=60).fit(df)
    w = model.weights
    got = 0.5 * (w[:-1] ** 2).sum() + 2.0 * np.maximum(0, np.abs(y - predictions(model, df)) - 0.2).sum()
    k = x @ x.T if kernel == "linear" else gaussian(x, x, 1 / 3)
    if kernel == "rbf":  # all rows are landmarks: the features give the kernel
        f = model.map(x)[:, :-1]
        assert np.allclose(f @ f.T, k, atol=1e-6)
    assert got <= 1.01 * least_loss(k, y, 2.0, 0.2)


def test_a_share_lies_outside_the_tube(small):
    df, _, y = small
    for nu in (0.2, 0.5):
        model = SupportRegressor("rbf", nu=nu, landmarks=30).fit(df)
        outside = np.mean(np.abs(y - predictions(model, df)) > model.epsilon)
        assert abs(outside - nu) <= 0.05 and model.epsilon > 0


def test_neighbours_equal_a_plain_vote(small, spark):
    df, x, y = small
    label = np.floor(y).astype(float)
    train = df.withColumn("label", F.floor("label").cast("double"))
    bag = NeighbourBag(estimators=4, k=3, seed=5, block=25)
    model = bag.fit(train)
    h = np.array([r.h for r in train.orderBy("id").select(F.xxhash64("features", "label").alias("h")).collect()])
    drawn, queries = draws(h, 4, 0.5, 5), np.vstack([x[:10] + 0.01, x[30:60]])
    ask = spark.createDataFrame([(i, q.tolist(), "x") for i, q in enumerate(queries)], "id long, features array<double>, e string").repartition(3)
    want = []
    for q in queries:
        votes = []
        for e, columns in enumerate(model.chosen):
            pool = [(((q[columns] - x[i][columns]) ** 2).sum(), h[i], label[i]) for i in range(60) for _ in range(drawn[i, e])]
            counts = Counter(v for *_, v in sorted(pool)[:3])
            votes.append(min(counts, key=lambda v: (-counts[v], v)))
        want.append(np.mean(votes))
    assert predictions(model, ask) == pytest.approx(want)
    assert {len(c) for c in model.chosen} == {1} and model.transform(ask).columns == ["id", "features", "e", "prediction"]


def test_draws_are_poisson():
    n = draws(np.arange(200_000, dtype=np.int64) * 7919, 2, 0.5, 1)
    share = np.bincount(n[:, 0], minlength=4)[:4] / len(n)
    assert share == pytest.approx([math.exp(-0.5) * 0.5 ** k / math.factorial(k) for k in range(4)], abs=5e-3)
    assert abs(np.corrcoef(n.T)[0, 1]) < 0.01 and _poisson(0.5, np.array([0.0, 0.999999])).tolist()[0] == 0


def test_descent_equals_a_plain_loop_and_least_squares(small):
    df, x, y = small
    model = SgdRegressor(epochs=300, tol=-math.inf, patience=10 ** 9, alpha=0.0, eta0=0.02).fit(df)
    z = np.column_stack([x, np.ones(60)])
    best = np.linalg.lstsq(z, y, rcond=None)[0]
    assert np.allclose(model.weights, best, atol=0.1) and predictions(model, df) == pytest.approx(z @ model.weights)
    state = [np.zeros(3), np.array([0.0, 0.0, np.inf, 0.0, 0.0])]
    rows = np.array([[1.0, 1.0, 2.0], [2.0, 1.0, 3.0]])
    w, t = np.zeros(3 - 1), 0
    for a, one, target in rows:
        t += 1
        e = a * w[0] + one * w[1] - target
        w = w - 0.1 / t ** 0.5 * np.array([e * a + 0.3 * w[0], e])
    got = descend([state[0][:2], state[1]], rows, 2, 0.3, 0.1, 0.5, 1e-3, 5)
    assert np.allclose(got[0], w) and got[1][0] == 2 and got[1][2] < math.inf


def test_descent_stops_when_nothing_is_gained():
    state = [np.zeros(2), np.array([0.0, 0.0, np.inf, 0.0, 0.0])]
    for _ in range(20):
        state = descend(state, np.array([[0.0, 1.0, 0.0]]), 1, 0.0, 0.1, 0.5, 1e-3, 3)
    assert state[1][4] == 1.0 and state[1][0] == 4


def test_no_rows(spark):
    none = spark.createDataFrame([], "id long, features array<double>, label double")
    one = spark.createDataFrame([(1, [0.5, 1.0])], "id long, features array<double>")
    for est in (SupportRegressor("linear"), SupportRegressor("rbf"), NeighbourBag()):
        assert est.fit(none).transform(none).count() == 0
    assert [r.prediction for r in NeighbourBag().fit(none).transform(one).collect()] == [None]
