"""Quality and toxicity: held-out accuracy, and small cases."""

import random

import numpy as np
import pytest

from kiln.llm import quality, toxicity
from kiln.llm.sample import fold_of, labelled_texts
from tests.llm.conftest import dicts, table

SF = "/root/testdata/sf0.01"


def _accuracy(spark, query, label):
    labels = dict(dicts(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", label))
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    return sum(p == y for p, y in held) / len(held), len(held)


def test_quality_is_right_on_held_out_labels(spark):
    share, n = _accuracy(spark, quality.op8_quality_classifier, "quality")
    assert n > 80 and share >= 0.95


def test_toxicity_is_right_on_held_out_labels(spark):
    share, n = _accuracy(spark, toxicity.op5_toxicity, "toxic")
    assert n > 50 and share >= 0.9


@pytest.fixture(scope="module")
def insults(spark):
    """Texts of which some hold one of three words, one of them harmless in a phrase."""
    rng = random.Random(5)
    words = ["".join(rng.choice("bdfgkmnprtvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(4000)]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            text.insert(rng.randint(0, len(text)), rng.choice(["jerk", "Jerkface", "dolthead!"]))
        elif i % 40 == 1:
            text.insert(rng.randint(0, len(text)), "jerk chicken")
        rows.append((i, " ".join(text), "s"))
        labels.append((i, 1, int(toxic)))
    return table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_lexicon_is_learned_and_matched_in_disguise(spark, insults):
    docs, labels = insults
    model = toxicity.toxic_model(docs, labels)
    assert any(p.startswith(" jerk") for p in model.weights) and any(p.startswith(" doith") for p in model.weights)
    cases = ["you JERK", "a j3rk", "a j.e.r.k", "ｊｅｒｋ", "jеrk", "such a d0lthe@d", "the jerk chicken was good", "nothing here", "", None]
    got = dict(dicts(toxicity.score_toxic(table(spark, [(i, t, "s") for i, t in enumerate(cases)]), model), "doc_id", "score"))
    assert [got[i] >= 0.5 for i in range(len(cases))] == [True] * 6 + [False] * 4


def test_longer_texts_score_less():
    assert toxicity.strength({"x": 3.0}, 10) > toxicity.strength({"x": 3.0}, 10_000) > 0


def test_copies_of_one_text_make_no_lexicon(spark):
    rows = [(i, "zarbo wimul kendo", "s") for i in range(40)] + [(100 + i, f"plain text number {i}", "s") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _, _ in rows], "doc_id long, toxic int")
    assert toxicity.toxic_model(table(spark, rows), labels).weights == {}


def test_scores_of_messy_rows(spark, messy, nothing, insults):
    docs, labels = insults
    for model, score in ((toxicity.toxic_model(docs, labels), toxicity.score_toxic), (None, toxicity.score_toxic),
                         (None, quality.score_quality)):
        got = score(messy, model)
        assert got.columns == [c for c in messy.columns if c != "score"] + ["score"]
        assert got.count() == 11 and all(0 <= r[0] <= 1 for r in dicts(got, "score"))
        assert score(nothing, model).count() == 0
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels_ in (none, none.limit(0)):
        assert quality.quality_model(messy, labels_) is None and toxicity.toxic_model(messy, labels_) is None
    assert quality.good_documents(messy, none).count() == 11


def test_quality_model_scores_messy_rows(spark, messy, nothing):
    rows = [(i, ("fine words of a text here " if i % 2 else "BAD!! BAD!! $$$ ") * (1 + i % 9), "s") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    model = quality.quality_model(table(spark, rows), labels)
    again = quality.quality_model(table(spark, rows), labels)
    assert (model.beta == again.beta).all() and (model.ys == again.ys).all()
    got = quality.score_quality(messy, model)
    assert got.count() == 11 and quality.score_quality(nothing, model).count() == 0
    good = quality.good_documents(table(spark, rows), labels)
    assert {i % 2 for i, in dicts(good, "doc_id")} == {1} and good.columns == ["doc_id", "text", "source"]


def test_isotonic_is_non_decreasing_and_pools():
    xs, ys = quality.isotonic(np.array([3.0, 1.0, 2.0, 4.0]), np.array([0.0, 0.0, 1.0, 1.0]))
    assert list(xs) == [1.0, 2.5, 4.0] and (np.diff(ys) > 0).all()


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(6, 3))
    phi = quality.features(x, np.zeros(3), np.ones(3), rng.normal(0, np.sqrt(0.4), (3, 20000)), rng.uniform(0, 2 * np.pi, 20000))[:, :-1]
    exact = np.exp(-0.2 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(phi @ phi.T - exact).max() < 0.05


def test_sample_is_bounded_and_repeatable(spark):
    docs = table(spark, [(i, str(i), "s") for i in range(4000)])
    labels = spark.createDataFrame([(i, 1) for i in range(4000)], "doc_id long, quality int")
    first = sorted(dicts(labelled_texts(docs, labels, "quality", fold_of("doc_id", 3) != 1, 500), "_id"))
    assert 350 < len(first) < 650
    assert first == sorted(dicts(labelled_texts(docs, labels, "quality", fold_of("doc_id", 3) != 1, 500), "_id"))
