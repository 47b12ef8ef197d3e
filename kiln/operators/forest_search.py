"""Random search over forest settings from nested forests.

Settings that differ in the number of trees, the depth or the least rows of a split
share their trees: the first k trees of a forest are the forest of k trees, and a
tree of less depth, or whose small nodes are not split, is the full tree cut off
there. One forest for each (features tried, least leaf, bootstrap) and fold is
grown to the most trees asked for, in blocks of trees that Spark deals to tasks;
each block yields the added-up predictions of its trees for every way of cutting
them, and running sums over the blocks score all settings.

Every task holds the table, whose size is checked; larger tables are searched by
``models.random_search``, a fit of row-distributed forests for each setting.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST_CELLS = 20_000_000  # numbers of the table that a task may hold


@dataclass(frozen=True)
class Grown:
    """A tree's nodes: feature and cut (feature -1: not split), sons, weighted mean and distinct rows."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    mean: np.ndarray
    rows: np.ndarray


def grow_tree(x: np.ndarray, y: np.ndarray, order: np.ndarray, weight: np.ndarray, tried: int, min_leaf: int, rng) -> Grown:
    """A full regression tree on the rows of positive ``weight``. ``order``: the row
    numbers of each feature by its value. Each node tries ``tried`` features drawn
    at random (all: every feature) and takes the cut midway between two values that
    lowers the weighted squared error most, with ``min_leaf`` distinct rows on
    either side. Nodes without such a cut or with one target value stay leaves.

    All nodes of a level are rated at once: rows of each feature, in the order of
    (node, value), give the sums left of every cut.
    """
    width = x.shape[1]
    used = weight > 0
    here = order[used[order]].reshape(width, -1)
    node_of = np.zeros(len(y), np.int64)
    feature, cut, left, right = [-1], [0.0], [-1], [-1]
    total_w = weight.sum()
    mean, count = [float((weight * y).sum() / total_w)], [int(used.sum())]
    features = np.arange(width)[:, None]
    while here.shape[1]:
        node = node_of[here]
        here = np.take_along_axis(here, np.argsort(node, axis=1, kind="stable"), axis=1)
        node = node_of[here[0]]
        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        size = np.diff(np.concatenate([starts, [len(node)]]))
        seg = np.repeat(np.arange(len(starts)), size)
        w, wy = weight[here], weight[here] * y[here]
        cw, cy = np.cumsum(w, axis=1), np.cumsum(wy, axis=1)
        base_w, base_y = cw[:, starts] - w[:, starts], cy[:, starts] - wy[:, starts]
        tw, ty = np.add.reduceat(w, starts, axis=1), np.add.reduceat(wy, starts, axis=1)
        wl, yl = cw - base_w[:, seg], cy - base_y[:, seg]
        wr, yr = tw[:, seg] - wl, ty[:, seg] - yl
        nl = np.arange(len(node)) - starts[seg] + 1
        value = x[here, features]
        allowed = np.zeros(value.shape, bool)
        allowed[:, :-1] = value[:, 1:] > value[:, :-1]
        allowed &= (nl >= min_leaf) & (size[seg] - nl >= min_leaf)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(allowed, yl * yl / wl + yr * yr / wr - (ty * ty / tw)[:, seg], -1.0)
        if tried < width:
            drawn = np.argsort(rng.random((len(starts), width)), axis=1)[:, :tried]
            chosen = np.zeros((len(starts), width), bool)
            np.put_along_axis(chosen, drawn, True, axis=1)
            gain[~chosen.T[:, seg]] = -1.0
        each = np.maximum.reduceat(gain, starts, axis=1)
        f = each.argmax(0)
        best = each[f, np.arange(len(starts))]
        splits = np.flatnonzero(best > 1e-12 * np.maximum(1.0, (ty * ty / tw)[0]))
        if not len(splits):
            break
        place = np.where(gain[f[seg], np.arange(len(node))] == best[seg], np.arange(len(node)), len(node))
        place = np.minimum.reduceat(place, starts)[splits]
        f = f[splits]
        at = (value[f, place] + value[f, place + 1]) / 2
        at = np.where(at >= value[f, place + 1], value[f, place], at)  # neighbours may have no number between them
        new = len(feature) + 2 * np.arange(len(splits))
        for k, old in enumerate(node[starts[splits]].tolist()):
            feature[old], cut[old], left[old], right[old] = int(f[k]), float(at[k]), int(new[k]), int(new[k]) + 1
        lw, ly, ln = wl[f, place], yl[f, place], nl[place]
        means = np.column_stack([ly / lw, (ty[f, splits] - ly) / (tw[f, splits] - lw)]).ravel()
        counts = np.column_stack([ln, size[splits] - ln]).ravel()
        mean += means.tolist()
        count += counts.tolist()
        for column in (feature, left, right):
            column += [-1] * (2 * len(splits))
        cut += [0.0] * (2 * len(splits))
        # rows of the split nodes go on, the others are done
        which = np.full(len(starts), -1)
        which[splits] = np.arange(len(splits))
        k = which[seg]
        rows = here[0][k >= 0]
        k = k[k >= 0]
        node_of[rows] = new[k] + (x[rows, f[k]] > at[k])
        going = np.zeros(len(y), bool)
        going[rows] = True
        here = here[going[here]].reshape(width, -1)
    return Grown(np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(mean), np.array(count))


def cut_predictions(tree: Grown, x: np.ndarray, depths: list, min_splits: list[int]) -> np.ndarray:
    """Predictions of the tree cut off at each depth (None: nowhere) whose nodes with
    less than each number of rows are not split: depths x numbers x rows."""
    out = np.empty((len(depths), len(min_splits), len(x)))
    at = [np.zeros(len(x), np.int64) for _ in min_splits]
    step, moving = 0, True
    while moving:
        for i, d in enumerate(depths):
            if d == step:
                out[i] = [tree.mean[a] for a in at]
        moving = False
        for k, m in enumerate(min_splits):
            a = at[k]
            go = np.flatnonzero((tree.feature[a] >= 0) & (tree.rows[a] >= m))
            if len(go):
                n = a[go]
                a[go] = np.where(x[go, tree.feature[n]] <= tree.cut[n], tree.left[n], tree.right[n])
                moving = True
        step += 1
    for i, d in enumerate(depths):
        if d is None or d >= step:
            out[i] = [tree.mean[a] for a in at]
    return out


def _block(x, y, order, scored, kind: tuple, trees: int, seed: list[int], depths, min_splits) -> np.ndarray:
    """Sum over a block's trees of their cut predictions."""
    features, min_leaf, bootstrap = kind
    width, total = x.shape[1], 0
    tried = width if features == "auto" else max(1, int(math.sqrt(width)))
    for t in range(trees):
        rng = np.random.default_rng([*seed, t])
        weight = np.bincount(rng.integers(0, len(y), len(y)), minlength=len(y)).astype(float) if bootstrap else np.ones(len(y))
        total = total + cut_predictions(grow_tree(x, y, order, weight, tried, min_leaf, rng), scored, depths, min_splits)
        if not bootstrap and tried == width:  # all trees are this one
            return total * trees
    return total


def _table(df: DataFrame, features: str, label: str, key: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, hash of the key) as arrays, in the order of the key."""
    from pyspark.ml.functions import vector_to_array
    x = F.col(features).cast("array<double>") if df.schema[features].dataType.typeName() == "array" else vector_to_array(features)
    got = df.orderBy(*key).select(x.alias("x"), F.col(label).cast("double").alias("y"), F.xxhash64(*key).alias("h")).toArrow()
    y = got.column("y").to_numpy()
    return got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1), y, got.column("h").to_numpy()


def fits_a_task(df: DataFrame, features: str) -> bool:
    """Whether the table is small enough to be held by every task."""
    first = df.select(features).first()
    return first is None or df.count() * len(first[0]) <= MOST_CELLS


def _summed(spark, x, y, parts: list, kinds: dict, block: int, seed: int, depths: list, min_splits: list[int]) -> DataFrame:
    """(kind, part, block, depth, least, row, s): summed predictions of each block of
    trees. ``parts``: (rows to fit on, rows to score); ``kinds``: number of blocks of each kind."""
    shared = spark.sparkContext.broadcast((x, y, parts))  # size checked by fits_a_task
    units = [(i, p, b) for i, blocks in enumerate(kinds.values()) for p in range(len(parts)) for b in range(blocks)]
    names = list(kinds)

    def work(batches):
        x, y, parts = shared.value
        for batch in batches:
            for i, p, b in zip(*(batch.column(c).to_pylist() for c in ("kind", "part", "block"))):
                fit, score = parts[p]
                sums = _block(x[fit], y[fit], np.argsort(x[fit], axis=0, kind="stable").T, x[score], names[i], block,
                              [seed, i, p, b], depths, min_splits)
                d, m, r = (a.ravel() for a in np.indices(sums.shape))
                yield pa.RecordBatch.from_pydict({"kind": pa.array(np.full(sums.size, i, np.int32)), "part": pa.array(np.full(sums.size, p, np.int32)),
                                                  "block": pa.array(np.full(sums.size, b, np.int32)), "depth": pa.array(d.astype(np.int32)),
                                                  "least": pa.array(m.astype(np.int32)), "row": pa.array(score[r]), "s": pa.array(sums.ravel())})
    todo = spark.createDataFrame(units, "kind int, part int, block int")
    return todo.repartition(len(units), "kind", "part", "block").mapInArrow(
        work, "kind int, part int, block int, depth int, least int, row long, s double")


def nested_search(train: DataFrame, settings: list[dict], folds: int = 3, seed: int = 0, key=("id",), features: str = "features",
                  label: str = "label", block: int = 200) -> list[dict]:
    """Mean squared error of each setting (n_estimators a multiple of ``block``,
    max_features ``auto`` or ``sqrt``, max_depth, min_samples_split, min_samples_leaf, bootstrap), averaged over ``folds``
    cross-validation folds by a hash of the key. Trees are seeded: a rerun gives the
    same numbers, and two settings are scored on the same trees where they can be."""
    spark = train.sparkSession
    x, y, h = _table(train, features, label, list(key))
    fold = (h % folds + folds) % folds
    parts = [(np.flatnonzero(fold != k), np.flatnonzero(fold == k)) for k in range(folds)]
    kinds: dict[tuple, int] = {}
    for s in settings:
        if s["n_estimators"] % block:
            raise ValueError(f"n_estimators must be a multiple of {block}")
        k = (s["max_features"], s["min_samples_leaf"], s["bootstrap"])
        kinds[k] = max(kinds.get(k, 0), s["n_estimators"] // block)
    depths = sorted({s["max_depth"] for s in settings}, key=lambda d: (d is None, d))
    min_splits = sorted({s["min_samples_split"] for s in settings})
    sums = _summed(spark, x, y, parts, kinds, block, seed, depths, min_splits)
    until = Window.partitionBy("kind", "part", "depth", "least", "row").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    truth = spark.createDataFrame(pa.table({"row": np.arange(len(y)), "y": y}))
    error = (sums.withColumn("p", F.sum("s").over(until) / ((F.col("block") + 1) * block)).join(truth, "row")
                 .groupBy("kind", "part", "block", "depth", "least").agg(F.avg((F.col("y") - F.col("p")) ** 2).alias("mse"))
                 .groupBy("kind", "block", "depth", "least").agg(F.avg("mse").alias("mse")))
    found = {(r.kind, r.block, r.depth, r.least): r.mse for r in error.collect()}
    number = {k: i for i, k in enumerate(kinds)}
    return [s | {"mean_mse": found[number[s["max_features"], s["min_samples_leaf"], s["bootstrap"]], s["n_estimators"] // block - 1,
                                   depths.index(s["max_depth"]), min_splits.index(s["min_samples_split"])]} for s in settings]


def forest_scores(train: DataFrame, sets: dict[str, DataFrame], setting: dict, seed: int = 0, key=("id",), features: str = "features",
                  label: str = "label", block: int = 200) -> dict[str, float]:
    """Mean squared error on each of ``sets`` of the forest of one setting fitted on all of ``train``."""
    spark = train.sparkSession
    x, y, _ = _table(train, features, label, list(key))
    others = {name: _table(df, features, label, list(key)) for name, df in sets.items()}
    every_x, every_y = np.concatenate([x, *(o[0] for o in others.values())]), np.concatenate([y, *(o[1] for o in others.values())])
    parts = [(np.arange(len(y)), np.arange(len(y), len(every_y)))]
    kind = (setting["max_features"], setting["min_samples_leaf"], setting["bootstrap"])
    sums = _summed(spark, every_x, every_y, parts, {kind: setting["n_estimators"] // block}, block, seed + 1, [setting["max_depth"]], [setting["min_samples_split"]])
    mean = {r["row"]: r["p"] for r in sums.groupBy("row").agg((F.sum("s") / setting["n_estimators"]).alias("p")).collect()}
    out, at = {}, len(y)
    for name, (_, own, _) in others.items():
        out[name] = float(np.mean([(own[i] - mean[at + i]) ** 2 for i in range(len(own))])) if len(own) else None
        at += len(own)
    return out
