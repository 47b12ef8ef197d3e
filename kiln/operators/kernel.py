"""Regression with an epsilon-insensitive loss, linear or by a Gaussian kernel.

A kernel is replaced by features of its landmarks (Nystroem): a bounded sample of
rows z gives phi(x) = k(x, z) K(z, z)^(-1/2), whose inner products equal the kernel
on the landmarks. In these features the loss is minimised by iteratively reweighted
least squares: each pass over the rows adds up weighted normal equations, a matrix
of fixed size. No matrix of rows by rows is ever made.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.boost import _matrix, _numbers


def summed(rows: DataFrame, make, groups: int = 16) -> np.ndarray | None:
    """Sum over all rows of ``make(x, y)``, an array of fixed length: one for each
    partition, then for each of ``groups`` sets of partitions, always in the same
    order. None without rows."""
    def part(batches):
        total = None
        for b in batches:
            if b.num_rows:
                got = make(np.stack(b.column("x").to_numpy(zero_copy_only=False)), b.column("y").to_numpy())
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_pydict({"s": pa.array([total.tobytes()], pa.binary())})

    def join(batches):
        total = sum((np.frombuffer(v) for b in batches for v in b.column("s").to_pylist()), start=np.zeros(1))
        if len(total) > 1:
            yield pa.RecordBatch.from_pydict({"p": pa.array([0]), "s": pa.array([total.tobytes()], pa.binary())})
    parts = rows.mapInArrow(part, "s binary").withColumn("p", F.spark_partition_id().cast("long"))
    if rows.rdd.getNumPartitions() > groups:
        parts = (parts.repartition(groups, F.pmod("p", F.lit(groups))).sortWithinPartitions("p")
                      .mapInArrow(join, "p long, s binary").withColumn("p", F.spark_partition_id().cast("long")))
    got = sorted(parts.collect(), key=lambda r: r["p"])
    return sum((np.frombuffer(r["s"]) for r in got[1:]), start=np.frombuffer(got[0]["s"])) if got else None


def gathered(rows: DataFrame, part_rows: int = 10_000) -> DataFrame:
    """``rows`` held for many passes, in no more partitions than one for each
    ``part_rows`` rows: a pass over few rows is then few tasks."""
    held = rows.persist(StorageLevel.MEMORY_AND_DISK)
    parts = -(-held.count() // part_rows) or 1
    if parts >= held.rdd.getNumPartitions():
        return held
    fewer = held.coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)
    fewer.count()
    held.unpersist()
    return fewer


@dataclass(frozen=True)
class KernelMap:
    """Features of rows: the numbers themselves, or those of landmarks; the last one is constant."""
    landmarks: np.ndarray | None
    root: np.ndarray | None
    gamma: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.landmarks is not None:
            x = gaussian(x, self.landmarks, self.gamma) @ self.root
        return np.column_stack([x, np.ones(len(x))])


def gaussian(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2.0 * a @ b.T
    return np.exp(-gamma * np.maximum(square, 0.0))


@dataclass(frozen=True)
class SupportModel:
    features: str
    map: KernelMap
    weights: np.ndarray
    epsilon: float

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        @F.arrow_udf("double")
        def score(lists: pa.Array) -> pa.Array:
            width = len(lists[0]) if len(lists) else 1
            return pa.array(self.map(_matrix(lists, width)) @ self.weights if len(lists) else np.empty(0))
        return df.withColumn(name, score(_numbers(df, self.features)))


@dataclass(frozen=True)
class SupportRegressor:
    """Minimises |w|^2 / 2 + ``c`` x sum of max(0, |y - f(x)| - ``epsilon``), the
    constant of f not counted in |w|. With ``nu`` the tube's half-width is not given
    but found so that a share ``nu`` of the rows, to a hundredth, lies outside it. ``kernel`` is
    ``linear`` or ``rbf`` with exp(-gamma |x - z|^2), gamma 1 / features unless given.

    ``landmarks`` rows at most, taken by a hash of their values, make the kernel's
    features; with as many as there are rows the kernel is exact. Rows without a
    label are left out.
    """
    kernel: str = "rbf"
    c: float = 1.0
    epsilon: float = 0.1
    nu: float | None = None
    gamma: float | None = None
    landmarks: int = 256
    max_iter: int = 60
    tol: float = 1e-5
    label: str = "label"
    features: str = "features"

    def fit(self, df: DataFrame) -> SupportModel:
        rows = gathered(df.select(_numbers(df, self.features).alias("x"), F.col(self.label).cast("double").alias("y"))
                          .where("y IS NOT NULL AND NOT isnan(y)"))
        try:
            phi, width = self._map(rows)
            if phi is None:
                return SupportModel(self.features, KernelMap(None, None, 0.0), np.zeros(1), self.epsilon)
            if self.nu is None:
                return SupportModel(self.features, phi, self._minimise(rows, phi, self.epsilon, np.zeros(width)), self.epsilon)
            # the share of rows outside falls as the tube widens
            low, high, weights = 0.0, float(rows.agg(F.max("y") - F.min("y")).first()[0]), np.zeros(width)
            for _ in range(12):
                mid = (low + high) / 2
                weights = self._minimise(rows, phi, mid, weights)
                n, out = summed(rows, lambda x, y, w=weights, e=mid: np.array([len(y), (np.abs(y - phi(x) @ w) > e).sum()], float))
                if abs(out / n - self.nu) <= 0.01:
                    break
                low, high = (mid, high) if out / n > self.nu else (low, mid)
            return SupportModel(self.features, phi, weights, mid)
        finally:
            rows.unpersist()

    def _map(self, rows: DataFrame) -> tuple[KernelMap | None, int]:
        first = rows.select("x").first()
        if first is None:
            return None, 1
        width = len(first[0])
        if self.kernel == "linear":
            return KernelMap(None, None, 0.0), width + 1
        gamma = self.gamma or 1.0 / width
        z = np.unique(np.array([r["x"] for r in rows.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(self.landmarks).collect()]), axis=0)
        value, vector = np.linalg.eigh(gaussian(z, z, gamma))
        good = value > 1e-10 * value.max()
        return KernelMap(z, vector[:, good] / np.sqrt(value[good]), gamma), int(good.sum()) + 1

    def _minimise(self, rows: DataFrame, phi: KernelMap, epsilon: float, w: np.ndarray) -> np.ndarray:
        c, d = self.c, len(w)
        free = np.ones(d)
        free[-1] = 1e-9  # the constant
        steps = np.array([0.0, 0.01, 0.05, 0.2, 0.5, 1.0])
        for _ in range(self.max_iter):
            def normal(x, y, w=w):
                f = phi(x)
                e = y - f @ w
                over = np.abs(e) - epsilon
                a = np.where(over > 0, c / np.maximum(over, 1e-4), 0.0)
                return np.concatenate([(f.T @ (f * a[:, None])).ravel(), f.T @ (a * (y - np.sign(e) * epsilon))])
            sums = summed(rows, normal)
            target = np.linalg.solve(sums[:d * d].reshape(d, d) + np.diag(free), sums[d * d:])

            def losses(x, y, w=w, move=target - w):
                f = phi(x)
                e = (y - f @ w)[:, None] - (f @ move)[:, None] * steps
                return np.maximum(0.0, np.abs(e) - epsilon).sum(0)
            tried = w[None] + steps[:, None] * (target - w)[None]
            value = 0.5 * (tried[:, :-1] ** 2).sum(1) + c * summed(rows, losses)
            best = int(value.argmin())
            w = tried[best]
            if best == 0 or value[0] - value[best] < self.tol * max(value[0], 1e-12):
                break
        return w
