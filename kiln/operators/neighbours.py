"""Bagged nearest neighbours by blocks of distance products."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.boost import _numbers
from kiln.session import checkpoint_root


def _poisson(share: float, u: np.ndarray) -> np.ndarray:
    """Poisson counts of a mean from uniform numbers."""
    out, p, total = np.zeros(u.shape, np.int64), math.exp(-share), math.exp(-share)
    for k in range(1, 20):
        out += u > total
        p *= share / k
        total += p
    return out


def draws(h: np.ndarray, estimators: int, share: float, seed: int) -> np.ndarray:
    """How often each estimator draws each row of hash h (rows x estimators)."""
    u = np.empty((len(h), estimators))
    for e in range(estimators):
        v = h.view(np.uint64) + np.uint64((seed * 1000003 + e + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            v = (v ^ (v >> np.uint64(shift))) * np.uint64(factor)
        u[:, e] = ((v ^ (v >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)
    return _poisson(share, u)


@dataclass(frozen=True)
class NeighbourBag:
    """``estimators`` classifiers by the commonest label (the smallest of equal
    ones) of the ``k`` nearest rows, each on a draw of the rows with replacement,
    ``rows`` of them on average, and on a share ``columns`` of the features; the
    prediction is the mean of their labels. A row is drawn as often as a Poisson
    count of its hash says, so that draws need no order of the rows.
    """
    estimators: int = 10
    k: int = 5
    rows: float = 0.5
    columns: float = 0.5
    seed: int = 0
    label: str = "label"
    features: str = "features"
    block: int = 4096

    def fit(self, df: DataFrame) -> NeighbourModel:
        checkpoint_root(df.sparkSession)
        rows = (df.select(_numbers(df, self.features).alias("x"), F.col(self.label).cast("double").alias("y"))
                  .where("y IS NOT NULL AND NOT isnan(y)").withColumn("h", F.xxhash64("x", "y")).checkpoint(eager=True))
        first = rows.select("x").first()
        rng = np.random.default_rng(self.seed)
        width = len(first[0]) if first else 1
        chosen = [np.sort(rng.choice(width, max(1, int(self.columns * width)), replace=False)) for _ in range(self.estimators)]
        return NeighbourModel(self, rows, chosen)


@dataclass(frozen=True)
class NeighbourModel:
    bag: NeighbourBag
    train: DataFrame
    chosen: list

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """``df`` with the prediction (null where nothing was drawn). Queries go to
        the training rows in blocks of ``block``, a broadcast of fixed size each;
        every partition of the rows keeps the k nearest of its own to a query, and
        only these are shuffled."""
        numbered = df.withColumn("_q", F.monotonically_increasing_id()).withColumn("_x", _numbers(df, self.bag.features)).checkpoint(eager=True)
        found, bag, chosen, k, spark = None, self.bag, self.chosen, self.bag.k, df.sparkSession
        order = numbered.select("_q", "_x")
        for batch in _blocks(order, self.bag.block):
            shared = spark.sparkContext.broadcast(batch)

            def nearest(batches, shared=shared):
                ids, queries = shared.value
                best: list = [None] * len(chosen)
                for b in batches:
                    if not b.num_rows:
                        continue
                    x, y, h = np.stack(b.column("x").to_numpy(zero_copy_only=False)), b.column("y").to_numpy(), b.column("h").to_numpy()
                    drawn = draws(h, len(chosen), bag.rows, bag.seed)
                    for e, columns in enumerate(chosen):
                        pick = np.repeat(np.arange(len(y)), drawn[:, e])
                        a, q = x[pick][:, columns], queries[:, columns]
                        d = np.maximum((q * q).sum(1)[:, None] + (a * a).sum(1)[None] - 2.0 * q @ a.T, 0.0)
                        own = d, np.broadcast_to(h[pick], d.shape), np.broadcast_to(y[pick], d.shape)
                        if best[e] is not None:
                            own = tuple(np.concatenate(two, axis=1) for two in zip(best[e], own))
                        keep = np.lexsort((own[1], own[0]), axis=1)[:, :k]
                        best[e] = tuple(np.take_along_axis(v, keep, axis=1) for v in own)
                for e, own in enumerate(best):
                    if own is not None and own[0].shape[1]:
                        m = own[0].shape[1]
                        yield pa.RecordBatch.from_pydict({"_q": np.repeat(ids, m), "e": pa.array(np.full(len(ids) * m, e, np.int32)),
                                                          "d": own[0].ravel(), "h": own[1].ravel(), "y": own[2].ravel()})
            near = self.train.mapInArrow(nearest, "_q long, e int, d double, h long, y double")
            # at most k from each partition meet; their first k vote
            first = F.slice(F.array_sort(F.collect_list(F.struct("d", "h", "y"))), 1, k)
            votes = near.groupBy("_q", "e").agg(first.alias("n")).select("_q", "e", F.explode("n").alias("n")).groupBy("_q", "e", F.col("n.y").alias("y")).count()
            label = votes.groupBy("_q", "e").agg(F.max_by("y", F.struct("count", -F.col("y"))).alias("y"))
            part = label.groupBy("_q").agg(F.avg("y").alias(name)).checkpoint(eager=True)
            found = part if found is None else found.unionByName(part)
        if found is None:
            return df.withColumn(name, F.lit(None).cast("double"))
        return numbered.drop(name, "_x").join(found, "_q", "left").drop("_q")


def _blocks(rows: DataFrame, size: int):
    """(ids, matrix) of the rows, ``size`` at a time."""
    ids, x = [], []
    for r in rows.toLocalIterator():
        ids.append(r["_q"])
        x.append(r["_x"])
        if len(ids) == size:
            yield np.array(ids), np.array(x, float)
            ids, x = [], []
    if ids:
        yield np.array(ids), np.array(x, float)
