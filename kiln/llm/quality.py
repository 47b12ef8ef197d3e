"""Quality classifier: random Fourier features over document statistics, ridge
regression by partition-summed normal equations, isotonic calibration."""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import table
from kiln.llm.registry import query
from kiln.llm.sample import fold_of, labelled_texts

# Classes of bytes: the statistics count each class in the UTF-8 text.
_CLASSES = {"u": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "l": "abcdefghijklmnopqrstuvwxyz", "d": "0123456789", "s": " \t\n\x0b\x0c\r",
            "p": ".,;:'\"-()?", "x": "!#$%&*+/<=>@[\\]^_`{|}~"}
_TABLE = bytearray(b"o" * 256)
for _k, _chars in _CLASSES.items():
    for _c in _chars:
        _TABLE[ord(_c)] = ord(_k)
_TABLE = bytes(_TABLE)
N_STATS = 16


def stats(text: str) -> list[float]:
    """``N_STATS`` statistics of a whole text; all 0 for an empty one."""
    words = text.split()
    if not words:
        return [0.0] * N_STATS
    raw = text.encode("utf-8", "replace")
    kinds = raw.translate(_TABLE)
    n, m = len(raw), len(words)
    upper, lower, digits, spaces, points, odd = (kinds.count(k) for k in (b"u", b"l", b"d", b"s", b"p", b"x"))
    lines = text.split("\n")
    distinct = set(words)
    doubled = sum(map(eq, words, words[1:]))
    shouts = text.count("!!")
    triples = sum(map(text.count, ("###", "$$$", "%%%", "&&&", "***")))
    bars = text.count(" | ")
    ends = text.count(". ") + text.count(".\n") + 1
    return [math.log1p(m), (n - spaces) / m, upper / n, lower / n, digits / n, points / n, odd / n, len(distinct) / math.sqrt(m),
            len(distinct) / m, doubled / m, shouts / m, triples / m, bars / m, len(set(lines)) / len(lines),
            math.log1p(m / len(lines)), math.log1p(m / ends)]


@dataclass(frozen=True)
class QualityModel:
    """Standardisation, frequencies and phases of the features, ridge weights, and
    the calibration as (score, value) points between which it is linear."""
    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    xs: np.ndarray
    ys: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return features(x, self.mean, self.scale, self.omega, self.phase) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.xs, self.ys)


def features(x, mean, scale, omega, phase) -> np.ndarray:
    """Random Fourier features: their inner products approximate a Gaussian
    kernel of the standardised statistics. The last one is constant."""
    z = np.clip((x - mean) / scale, -6, 6)
    return np.hstack([math.sqrt(2.0 / len(phase)) * np.cos(z @ omega + phase), np.ones((len(z), 1))])


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing step means of y in order of raw (pool adjacent violators),
    as points; one pseudo-count on either side keeps them inside (0, 1)."""
    blocks: list[list[float]] = []  # sum of y, rows, sum of raw
    for i in np.argsort(raw, kind="stable"):
        blocks.append([y[i], 1, raw[i]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([(b[0] + 0.5) / (b[1] + 1) for b in blocks])


_SUMS = "part int, n long, sums binary"


def _partition_sums(rows: DataFrame, parts: int, make) -> np.ndarray:
    """Sum over all rows of ``make(x, y)`` (an array of fixed shape): one sum per
    partition, rows in order of the id, added up in order of the partitions."""
    def sums(batches):
        total, n = None, 0
        for b in batches:
            x = np.array(b.column("x").to_pylist(), dtype=float).reshape(-1, N_STATS)
            got = make(x, b.column("y").to_numpy(zero_copy_only=False))
            total, n = got if total is None else total + got, n + len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"part": pa.array([0], pa.int32()), "n": pa.array([n], pa.int64()),
                                              "sums": pa.array([total.tobytes()], pa.binary())})
    got = (rows.repartition(parts, F.pmod(F.xxhash64("id"), F.lit(parts))).sortWithinPartitions("id", "y")
               .mapInArrow(sums, _SUMS).withColumn("part", F.spark_partition_id()).collect())
    return sum((np.frombuffer(r.sums) for r in sorted(got, key=lambda r: r.part)), start=np.zeros(1))


def stat_rows(texts: DataFrame) -> DataFrame:
    """(id, x, y): the statistics of labelled texts."""
    def rows(batches):
        for b in batches:
            x = [stats(t.as_py()) for t in b.column("_text")]
            yield pa.RecordBatch.from_pydict({"id": b.column("_id"), "x": pa.array(x, pa.list_(pa.float64())), "y": b.column("_y")})
    return texts.mapInArrow(rows, f"id {texts.schema['_id'].dataType.simpleString()}, x array<double>, y double")


def fit_quality(texts: DataFrame, n_features: int = 256, gamma: float = 0.05, ridge: float = 1e-3, parts: int = 8,
                seed: int = 7) -> QualityModel | None:
    """Model from labelled texts (``labelled_texts``, a bounded sample). A fifth of
    the rows, by a hash of the id, only calibrates. None without labelled rows.

    ``parts`` partitions each sum Phi'Phi and Phi'y, a matrix of fixed size; the
    driver adds and solves them.
    """
    rows = stat_rows(texts).persist()
    try:
        apart = F.pmod(F.xxhash64(F.lit("calibrate"), "id"), F.lit(5)) == 0
        fit_rows, held = rows.where(~apart), rows.where(apart)
        moments = _partition_sums(fit_rows, parts, lambda x, y: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]))
        if len(moments) == 1:
            return None
        n = moments[0]
        mean = moments[1:1 + N_STATS] / n
        scale = np.sqrt(np.maximum(moments[1 + N_STATS:] / n - mean ** 2, 1e-12)) + 1e-3
        rng = np.random.default_rng(seed)
        omega = rng.normal(0.0, math.sqrt(2 * gamma), (N_STATS, n_features))
        phase = rng.uniform(0, 2 * math.pi, n_features)
        d = n_features + 1

        def normal(x, y):
            phi = features(x, mean, scale, omega, phase)
            return np.concatenate([(phi.T @ phi).ravel(), phi.T @ y])
        sums = _partition_sums(fit_rows, parts, normal)
        gram, right = sums[:d * d].reshape(d, d), sums[d * d:]
        beta = np.linalg.solve(gram + ridge * n / d * np.eye(d), right)
        own = held.orderBy("id").collect() or fit_rows.orderBy("id").collect()
        x, y = np.array([r.x for r in own]), np.array([r.y for r in own])
        xs, ys = isotonic(features(x, mean, scale, omega, phase) @ beta, y)
        return QualityModel(mean, scale, omega, phase, beta, xs, ys)
    finally:
        rows.unpersist()


def score_quality(docs: DataFrame, model: QualityModel | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text added or replaced; null
    counts as empty, which is scored like any text. Without a model it is 0.5.
    Rows pass one by one; repeated rows get the same score."""
    names = [c for c in docs.columns if c != name]
    kept = docs.select(*names)
    if model is None:
        return kept.withColumn(name, F.lit(0.5))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + f", `{name}` double"

    def score(batches):
        for b in batches:
            x = np.array([stats(t.as_py() or "") for t in b.column(text_col)], dtype=float).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.score(x), pa.float64())], names=[*names, name])
    return kept.mapInArrow(score, schema)


def quality_model(docs: DataFrame, labels: DataFrame, max_rows: int = 20000) -> QualityModel | None:
    """Model of ``labels.quality``, from labels outside the held-out fold
    (crc32 of the id mod 3 = 1), about ``max_rows`` of them."""
    return fit_quality(labelled_texts(docs, labels, "quality", fold_of("doc_id", 3) != 1, max_rows))


def good_documents(docs: DataFrame, labels: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, all columns unchanged."""
    model = quality_model(docs, labels, **options)
    return score_quality(docs, model, name="_kiln_quality").where(F.col("_kiln_quality") >= least).drop("_kiln_quality")


@query("op8_quality_classifier")
def op8_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
