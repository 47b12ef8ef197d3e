"""Second-order gradient boosting on histograms (M8).

Features are binned once. A tree grows in rounds: one aggregate over the rows adds
up gradients and second derivatives by (open leaf, feature, bin), every cut of
these histograms, of fixed size whatever the rows, is rated in one place, and the
next round counts the smaller son of each new split; its brother is what is left.
Rounds are jobs of the driver over the stored bins. A table that is one part only
goes to one task, which makes all rounds by itself; sums are whole numbers, so that
both ways grow the same trees.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.indexing import running_sums
from kiln.session import checkpoint_root

OBJECTIVES = {  # (gradient, second derivative) of the loss by the margin
    "squared": lambda m, y: (m - y, np.ones_like(y)),
    "poisson": lambda m, y: (np.exp(m) - y, np.exp(m)),
}


def bin_cuts(df: DataFrame, vec: str, bins: int) -> list[np.ndarray]:
    """Upper bounds of each feature's bins: all its values if there are ``bins`` or
    fewer, else about equally filled ones that end at values. The driver receives
    features x bins numbers; values are counted and ranked in the cluster."""
    melted = df.select(F.posexplode(vec).alias("f", "v")).where("v IS NOT NULL AND NOT isnan(v)")
    counts = melted.groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_sums(counts, "f", "v", {"upto": "n"})
    whole = counts.groupBy("f").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("values"))
    at = F.when(F.col("values") <= bins, F.col("v")).otherwise(F.floor((F.col("upto") - 1) * bins / F.col("all")).cast("double"))
    ends = ranked.join(whole, "f").groupBy("f", at.alias("at")).agg(F.max("v").alias("end"))
    out: dict[int, list] = {}
    for r in ends.collect():
        out.setdefault(r["f"], []).append(r["end"])
    return [np.sort(np.array(out.get(i, []), float)) for i in range(max(out, default=-1) + 1)]


@dataclass
class Tree:
    """Nodes by number; node i goes left where the feature's bin is ``cut`` or less."""
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [0.0])

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        feature, cut, left, right = (np.array(a) for a in (self.feature, self.cut, self.left, self.right))
        at = np.zeros(len(x), np.int64)
        while len(open_ := np.flatnonzero(feature[at] >= 0)):
            n = at[open_]
            at[open_] = np.where(x[open_, feature[n]] <= cut[n], left[n], right[n])
        return at

    def split(self, i: int, feature: int, cut: int) -> tuple[int, int]:
        a = len(self.feature)
        for name, v in (("feature", -1), ("cut", 0), ("left", -1), ("right", -1), ("value", 0.0)):
            getattr(self, name).extend([v, v])
        self.feature[i], self.cut[i], self.left[i], self.right[i] = feature, cut, a, a + 1
        return a, a + 1


@dataclass(frozen=True)
class BoostModel:
    trees: list
    cuts: list
    base: float
    objective: str
    features: str

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with the prediction, worked out where a row is read."""
        @F.arrow_udf("double")
        def score(lists: pa.Array) -> pa.Array:
            margin = np.full(len(lists), self.base)
            x = self.binned(_matrix(lists, len(self.cuts))) if self.trees else None
            for t in self.trees:
                margin += np.array(t.value)[t.leaf(x)]
            return pa.array(np.exp(margin) if self.objective == "poisson" else margin)
        return df.withColumn(name, score(_numbers(df, self.features)))

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bins of each value: 0 without one, else 1 + the cuts below it; above all cuts the last."""
        out = np.zeros(x.shape, np.uint8)
        for f, cuts in enumerate(self.cuts):
            if len(cuts):
                out[:, f] = np.where(np.isnan(x[:, f]), 0, 1 + np.minimum(np.searchsorted(cuts, x[:, f]), len(cuts) - 1))
        return out


def _numbers(df: DataFrame, features: str):
    """The feature column, a vector or an array, as an array of doubles."""
    return F.col(features).cast("array<double>") if df.schema[features].dataType.typeName() == "array" else vector_to_array(features)


def _bins(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


@dataclass(frozen=True)
class Booster:
    """M8: boosted trees for a numeric label. ``max_leaves`` leaves are grown best
    first (None: no limit), to ``max_depth`` at most; a leaf's value is
    -G / (H + ``l2``) x ``step``, a split gains half of what it adds to the sum of
    G^2 / (H + ``l2``). Sides need ``min_rows`` rows and ``min_weight`` of H. ``base`` is the first margin (None:
    the label's mean, its logarithm for counts).

    Gradients are added up as whole multiples of a small unit that fits the label,
    so that a rerun, whatever its partitions, grows the same trees; of equal cuts
    the first feature's lowest counts. Missing values lie below all others. Rows
    without a label are left out.
    """
    trees: int = 100
    step: float = 0.1
    max_leaves: int | None = None
    max_depth: int | None = None
    l2: float = 0.0
    min_rows: int = 1
    min_weight: float = 1e-3
    base: float | None = None
    bins: int = 254
    objective: str = "squared"
    label: str = "label"
    features: str = "features"
    part_rows: int = 200_000

    def fit(self, df: DataFrame) -> BoostModel:
        checkpoint_root(df.sparkSession)
        rows = df.select(_numbers(df, self.features).alias("_x"), F.col(self.label).cast("double").alias("_y")).where("_y IS NOT NULL AND NOT isnan(_y)")
        n, mean, top = rows.agg(F.count(F.lit(1)), F.avg("_y"), F.max(F.abs("_y"))).first()
        cuts = bin_cuts(rows, "_x", self.bins)
        base = self.base if self.base is not None or not n else math.log(max(mean, 1e-9)) if self.objective == "poisson" else mean
        model = BoostModel([], cuts, float(base or 0.0), self.objective, self.features)
        if not n:
            return model
        unit = 2.0 ** (math.floor(math.log2(4.0 * n * max(top, abs(model.base), 1.0))) - 61)
        parts = -(-n // self.part_rows)
        state = self._start(rows, model, parts)
        grow = self._grow_here if parts == 1 else self._grow_by_jobs
        model.trees.extend(grow(state, cuts, unit))
        return model

    def _grow_by_jobs(self, state: DataFrame, cuts: list, unit: float):
        """All trees, a job for each round."""
        held = []
        for k in range(self.trees):
            tree = self._grow(partial(self._histograms, state, cuts, unit), unit)
            yield tree
            # from now on the margin of each row holds the new tree; lineage is cut now and then
            state = _moved(state, tree, len(cuts))
            if k % 25 < 24:
                state = state.persist(StorageLevel.MEMORY_AND_DISK)
                held.append(state)
            else:
                state = state.checkpoint(eager=True)
            if k % 25 == 24 or k == self.trees - 1:
                while held:
                    held.pop().unpersist()

    def _grow_here(self, state: DataFrame, cuts: list, unit: float):
        """All trees, grown by the one task that holds the rows."""
        def task(batches):
            got = pa.Table.from_batches(batches)
            x, y, margin = _bins(got.column("bins"), len(cuts)), got.column("y").to_numpy(), got.column("margin").to_numpy().copy()
            for k in range(self.trees):
                tree = self._grow(lambda t, leaves: self._sized(self._cells(t, leaves, cuts, unit, x, margin, y), leaves, cuts), unit)
                margin += np.array(tree.value)[tree.leaf(x)]
                yield pa.RecordBatch.from_pydict({"tree": pa.array([k], pa.int32())} | {
                    c: pa.array([getattr(tree, c)], pa.list_(pa.float64())) for c in ("feature", "cut", "left", "right", "value")})
        got = state.mapInArrow(task, "tree int, feature array<double>, cut array<double>, left array<double>, right array<double>, value array<double>")
        for r in sorted(got.collect(), key=lambda r: r["tree"]):
            yield Tree(*([int(v) for v in r[c]] for c in ("feature", "cut", "left", "right")), list(r["value"]))

    def _start(self, rows: DataFrame, model: BoostModel, parts: int) -> DataFrame:
        width, base = len(model.cuts), model.base

        def to_bins(batches):
            for b in batches:
                x = model.binned(_matrix(b.column("_x"), width))
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), b.column("_y"), pa.array(np.full(len(x), base))],
                                                 names=["bins", "y", "margin"])
        return rows.repartition(parts).mapInArrow(to_bins, "bins binary, y double, margin double").checkpoint(eager=True)

    def _grow(self, count, unit: float) -> Tree:
        """One tree. ``count(tree, leaves)`` gives the histograms of leaves, which are
        split in the order of their gain; a round counts all leaves that this order
        reaches and whose sons are not known yet."""
        tree = Tree()
        hist = {0: count(tree, [0])[0]}
        depth, best, sons = {0: 0}, {}, {}
        best[0] = self._best(hist[0], unit)
        while True:
            reached, missing = self._order(best, sons)
            if not missing:
                break
            small = {}
            for i in missing:
                sons[i] = tree.split(i, best[i][1], best[i][2])
                left_rows, rows = best[i][3], hist[i][2][0].sum()
                small[i] = 0 if 2 * left_rows <= rows else 1
            counted = count(tree, [sons[i][small[i]] for i in missing])
            for i, h in zip(missing, counted):
                a, b = sons[i][small[i]], sons[i][1 - small[i]]
                hist[a], hist[b] = h, hist.pop(i) - h
                for s in (a, b):
                    depth[s] = depth[i] + 1
                    best[s] = self._best(hist[s], unit) if self.max_depth is None or depth[s] < self.max_depth else None
            for s in [s for s in hist if best[s] is None]:
                best[s] = (0.0, -1, 0, 0, *self._sums(hist.pop(s), unit))
        return self._finish(tree, reached, best, sons)

    def _order(self, best: dict, sons: dict) -> tuple[set, list]:
        """(leaves split, those among them whose sons are not known) if leaves are
        split by falling gain while there may be more."""
        heap = [(-best[0][0], 0)] if best[0][0] > 0 else []
        reached, missing = set(), []
        while heap and (self.max_leaves is None or len(reached) < self.max_leaves - 1):
            _, i = heapq.heappop(heap)
            reached.add(i)
            if i not in sons:
                missing.append(i)
                continue
            for s in sons[i]:
                if best[s][0] > 0:
                    heapq.heappush(heap, (-best[s][0], s))
        return reached, missing

    def _finish(self, tree: Tree, reached: set, best: dict, sons: dict) -> Tree:
        """The tree with the splits of ``reached`` only, numbered anew, and its leaves' values."""
        out, stack = Tree(), [(0, 0)]
        while stack:
            old, new = stack.pop()
            if old in reached:
                stack += zip(sons[old], out.split(new, tree.feature[old], tree.cut[old]))
            else:
                g, h = best[old][4:]
                out.value[new] = -self.step * g / (h + self.l2) if h + self.l2 > 0 else 0.0
        return out

    def _sums(self, hist: np.ndarray, unit: float) -> tuple[float, float]:
        return float(hist[0][0].sum()) * unit, float(hist[1][0].sum()) * unit

    def _best(self, hist: np.ndarray, unit: float) -> tuple:
        """(gain, feature, cut, rows on its left, G, H) of a leaf's best cut; gain 0 if none is allowed."""
        g, h, n = (np.cumsum(hist[k], axis=1) for k in range(3))
        gl, hl, nl = g * unit, h * unit, n
        gt, ht, nt = gl[:, -1:], hl[:, -1:], nl[:, -1:]
        gr, hr, nr = (g[:, -1:] - g) * unit, (h[:, -1:] - h) * unit, nt - nl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 0.5 * (gl ** 2 / (hl + self.l2) + gr ** 2 / (hr + self.l2) - gt ** 2 / (ht + self.l2))
        allowed = (nl >= self.min_rows) & (nr >= self.min_rows) & (nl > 0) & (nr > 0) & (hl >= self.min_weight) & (hr >= self.min_weight)
        gain = np.where(allowed & np.isfinite(gain), gain, 0.0)
        f, cut = np.unravel_index(int(gain.argmax()), gain.shape)
        return max(0.0, float(gain[f, cut])), int(f), int(cut), int(nl[f, cut]), *self._sums(hist, unit)

    def _cells(self, tree: Tree, leaves: list[int], cuts: list, unit: float, x: np.ndarray, margin: np.ndarray, y: np.ndarray) -> np.ndarray:
        """(gradient, second derivative, rows) of rows for each leaf, feature and bin, in whole units."""
        width, deep = len(cuts), _deepest(cuts)
        index = np.full(len(tree.feature), -1)
        index[leaves] = np.arange(len(leaves))
        own = index[tree.leaf(x)]
        here = own >= 0
        g, h = OBJECTIVES[self.objective](margin[here], y[here])
        at = ((own[here, None] * width + np.arange(width)) * deep + x[here]).ravel()
        total = np.zeros((3, len(leaves) * width * deep), np.int64)
        for k, v in enumerate((np.rint(g / unit), np.rint(h / unit), np.ones(len(g)))):
            np.add.at(total[k], at, np.repeat(v.astype(np.int64), width))
        return total

    def _sized(self, total: np.ndarray, leaves: list[int], cuts: list) -> list[np.ndarray]:
        return list(total.reshape(3, len(leaves), len(cuts), _deepest(cuts)).transpose(1, 0, 2, 3))

    def _histograms(self, state: DataFrame, cuts: list, unit: float, tree: Tree, leaves: list[int]) -> list[np.ndarray]:
        """For each leaf an array (gradient, second derivative, rows) x feature x bin.
        Tasks add up their rows; only used cells are shuffled."""
        def add(batches):
            total = np.zeros((3, len(leaves) * len(cuts) * _deepest(cuts)), np.int64)
            for b in batches:
                total += self._cells(tree, leaves, cuts, unit, _bins(b.column("bins"), len(cuts)), b.column("margin").to_numpy(), b.column("y").to_numpy())
            used = np.flatnonzero(total[2])
            yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(t[used]) for t in total)], names=["cell", "g", "h", "n"])
        sums = state.mapInArrow(add, "cell long, g long, h long, n long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()
        out = np.zeros((3, len(leaves) * len(cuts) * _deepest(cuts)), np.int64)
        out[:, sums.column("cell").to_numpy()] = [sums.column(c).to_numpy() for c in ("g", "h", "n")]
        return self._sized(out, leaves, cuts)


def _deepest(cuts: list) -> int:
    return 1 + max((len(c) for c in cuts), default=0)


def _moved(state: DataFrame, tree: Tree, width: int) -> DataFrame:
    value = np.array(tree.value)

    def move(batches):
        for b in batches:
            x = _bins(b.column("bins"), width)
            yield pa.RecordBatch.from_arrays([b.column("bins"), b.column("y"), pa.array(b.column("margin").to_numpy() + value[tree.leaf(x)])],
                                             names=["bins", "y", "margin"])
    return state.mapInArrow(move, "bins binary, y double, margin double")
