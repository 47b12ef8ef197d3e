"""Boosted trees against a plain version that rates every cut of every leaf, one split at a time."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators.boost import Booster, bin_cuts


def plain_boost(x, y, trees, step, max_leaves, max_depth, l2, min_rows, base, objective="squared"):
    """Predictions of best-first boosting; None is below every value."""
    n, margin = len(x), [base] * len(x)
    key = [[-math.inf if v is None else v for v in row] for row in x]
    for _ in range(trees):
        g = [(math.exp(m) if objective == "poisson" else m) - t for m, t in zip(margin, y)]
        h = [math.exp(m) if objective == "poisson" else 1.0 for m in margin]

        def score(rows):
            return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + l2)

        def best(rows, depth):
            found = (0.0, None, None, rows, depth)
            if max_depth is None or depth < max_depth:
                for f in range(len(x[0])):
                    for cut in sorted({key[i][f] for i in rows})[:-1]:
                        left, right = [i for i in rows if key[i][f] <= cut], [i for i in rows if key[i][f] > cut]
                        gain = 0.5 * (score(left) + score(right) - score(rows))
                        if min(len(left), len(right)) >= min_rows and gain > found[0] + 1e-9:
                            found = gain, left, right, rows, depth
            return found
        leaves = [best(list(range(n)), 0)]
        while max_leaves is None or len(leaves) < max_leaves:
            top = max(leaves, key=lambda b: b[0])
            if top[1] is None:
                break
            leaves.remove(top)
            leaves += [best(top[1], top[4] + 1), best(top[2], top[4] + 1)]
        for _, _, _, rows, _ in leaves:
            value = -step * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + l2)
            for i in rows:
                margin[i] += value
    return [math.exp(m) for m in margin] if objective == "poisson" else margin


def table(seed, n=90):
    rng = random.Random(seed)
    x = [[rng.choice([None, 0.0, 1.0, 2.0]), rng.random() * 9, float(rng.randrange(3))] for _ in range(n)]
    return x, [float(int(2 + (a or 5) * 2 + b * 3 + (4 if b > 5 else 0) * c + rng.random() * 4)) for a, b, c in x]


def frame(spark, x, y):
    return spark.createDataFrame([(i, [math.nan if v is None else v for v in a], b) for i, (a, b) in enumerate(zip(x, y))],
                                 "id long, features array<double>, label double").repartition(3)


CASES = [dict(step=0.3, max_leaves=None, max_depth=3, l2=1.0, min_rows=1, base=0.5), dict(step=0.2, max_leaves=6, max_depth=None, l2=0.0, min_rows=5, base=None)]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("objective", ["squared", "poisson"])
def test_trees_equal_plain_ones(spark, case, objective):
    x, y = table(1)
    case = case | {"objective": objective}
    if objective == "poisson":
        case["base"] = math.log(sum(y) / len(y)) if case["base"] is None else case["base"]
    want = plain_boost(x, y, 8, **case | {"base": sum(y) / len(y) if case["base"] is None else case["base"]})
    got = {r.id: r.prediction for r in Booster(trees=8, **case).fit(frame(spark, x, y)).transform(frame(spark, x, y)).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(want, rel=1e-6)


def test_jobs_and_one_task_grow_the_same_trees(spark):
    x, y = table(2)
    options = dict(trees=3, step=0.3, max_leaves=7, min_rows=3)
    one, many = (Booster(part_rows=k, **options).fit(frame(spark, x, y)) for k in (1000, 40))
    assert [(t.feature, t.cut, t.left, t.right, t.value) for t in one.trees] == [(t.feature, t.cut, t.left, t.right, t.value) for t in many.trees]
    assert len(one.trees[0].feature) == 13


def test_bins(spark):
    rng = random.Random(3)
    rows = [([float(rng.randrange(5)), rng.random(), math.nan, 1.0 if i == 7 else 0.0],) for i in range(500)]
    cuts = bin_cuts(spark.createDataFrame(rows, "v array<double>"), "v", 20)
    assert cuts[0].tolist() == [0, 1, 2, 3, 4] and len(cuts[1]) == 20 and cuts[2].tolist() == [] and cuts[3].tolist() == [0, 1]
    share = np.histogram([r[0][1] for r in rows], np.concatenate([[-1], cuts[1]]))[0]
    assert cuts[1][-1] == max(r[0][1] for r in rows) and share.max() <= 26


def test_rows_without_label_and_no_rows(spark):
    x, y = table(4, 40)
    df = frame(spark, x, y)
    spoiled = df.unionByName(df.withColumn("label", F.lit(None).cast("double")))
    a, b = (Booster(trees=2, max_leaves=3).fit(d) for d in (df, spoiled))
    assert [t.value for t in a.trees] == [t.value for t in b.trees]
    none = Booster(trees=2).fit(df.where("id < 0"))
    assert none.trees == [] and {r.prediction for r in none.transform(df).collect()} == {0.0}
