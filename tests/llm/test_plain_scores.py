"""Scores of whole tables against plain Python scorers of the same models, and the
fitted sums against sums over all rows at once."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm import quality, toxicity
from kiln.llm.sample import fold_of, labelled_texts
from tests.llm.conftest import dicts

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs.union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "  \n ")], "doc_id long, text string")), spark.read.parquet(f"{SF}/labels.parquet")


def plain_toxic(model, text):
    words = toxicity.fold(text or "")
    joined = f" {' '.join(words)} "

    def places(p):
        return [i for i in range(len(joined)) if joined.startswith(p, i)] if words else []
    spared = [(i, i + len(p) - 1) for p in model.exceptions for i in places(p)]
    total = sum(w for p, w in model.weights.items() if any(not any(a <= i < z for a, z in spared) for i in places(p)))
    return 1 / (1 + math.exp(-min(30, max(-30, model.slope * total / math.log2(8 + len(words)) + model.offset))))


def test_toxicity_equals_a_plain_search(tables):
    docs, labels = tables
    model = toxicity.toxic_model(docs, labels)
    some = docs.where("doc_id % 7 = 0 OR doc_id < 0")
    rows = dicts(toxicity.score_toxic(some, model), "doc_id", "text", "score")
    assert len(rows) > 100 and len(model.weights) >= 3
    for _, text, score in rows:
        assert score == pytest.approx(plain_toxic(model, text), rel=1e-9)


def plain_stats(text):
    words = text.split()
    if not words:
        return [0.0] * 16
    raw, m = text.encode(), len(words)
    n = len(raw)

    def share(chars, of=n):
        return sum(b in chars.encode() for b in raw) / of
    lines = text.split("\n")
    ends = text.count(". ") + text.count(".\n") + 1
    return [math.log1p(m), sum(b not in b" \t\n\x0b\x0c\r" for b in raw) / m, share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("abcdefghijklmnopqrstuvwxyz"),
            share("0123456789"), share(".,;:'\"-()?"), share("!#$%&*+/<=>@[\\]^_`{|}~"), len(set(words)) / math.sqrt(m), len(set(words)) / m,
            sum(a == b for a, b in zip(words, words[1:])) / m, text.count("!!") / m, sum(text.count(t) for t in ("###", "$$$", "%%%", "&&&", "***")) / m,
            text.count(" | ") / m, len(set(lines)) / len(lines), math.log1p(m / len(lines)), math.log1p(m / ends)]


def plain_quality(model, text):
    z = [min(6.0, max(-6.0, (v - m) / s)) for v, m, s in zip(plain_stats(text or ""), model.mean, model.scale)]
    d = len(model.phase)
    raw = sum(math.sqrt(2 / d) * math.cos(sum(a * model.omega[i, k] for i, a in enumerate(z)) + model.phase[k]) * model.beta[k] for k in range(d)) + model.beta[d]
    if raw <= model.xs[0]:
        return model.ys[0]
    for (a, b), (u, v) in zip(zip(model.xs, model.xs[1:]), zip(model.ys, model.ys[1:])):
        if a <= raw <= b:
            return u + (v - u) * (raw - a) / (b - a)
    return model.ys[-1]


def test_quality_equals_a_plain_scorer_and_its_sums(tables):
    docs, labels = tables
    model = quality.quality_model(docs, labels)
    some = docs.where("doc_id % 9 = 0 OR doc_id < 0")
    for _, text, score in dicts(quality.score_quality(some, model), "doc_id", "text", "score"):
        assert score == pytest.approx(plain_quality(model, text), abs=1e-7)
    # ridge weights from all rows at once
    rows = labelled_texts(docs, labels, "quality", fold_of("doc_id", 3) != 1, 20000)
    fit = rows.where(F.pmod(F.xxhash64(F.lit("calibrate"), "_id"), F.lit(5)) != 0).orderBy("_id").collect()
    x, y = np.array([plain_stats(r["_text"]) for r in fit]), np.array([r["_y"] for r in fit])
    mean, scale = x.mean(0), np.sqrt(np.maximum(x.var(0), 1e-12)) + 1e-3
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, scale, rtol=1e-4)
    phi = quality.features(x, model.mean, model.scale, model.omega, model.phase)
    d = phi.shape[1]
    beta = np.linalg.solve(phi.T @ phi + 1e-3 * len(x) / d * np.eye(d), phi.T @ y)
    assert np.allclose(phi @ beta, phi @ model.beta, atol=1e-6)


def test_isotonic_means_are_the_best_rising_ones():
    rng = np.random.default_rng(1)
    for _ in range(30):
        raw, y = rng.permutation(12).astype(float), rng.integers(0, 2, 12).astype(float)
        xs, ys = quality.isotonic(raw, y)
        own = y[np.argsort(raw)]
        # the value at each place is the greatest, over starts, of the least mean from there to any later end
        want = [max(min(own[a:b + 1].mean() for b in range(k, 12)) for a in range(k + 1)) for k in range(12)]
        sizes = [sum(1 for w in want if w == v) for v in dict.fromkeys(want)]
        assert len(xs) == len(sizes) and np.allclose(ys, [(v * n + 0.5) / (n + 1) for v, n in zip(dict.fromkeys(want), sizes)])
