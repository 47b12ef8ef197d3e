"""Language identification: all segmentations counted by hand, and held-out documents."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.llm.language import Pieces, fit_languages, learn_languages, predict_language, unit_of, words_of, word_counts
from kiln.llm.sample import fold_of
from tests.llm.conftest import dicts, with_clashes

VOCABULARY = [b" ", b" a", b"a", b"ab", b"abc", b"b", b"bc", b"ca", b" ab", b"\xc3\xa9", b"a\xc3", b"C", b"1", b"b!"]


def segmentations(unit, names):
    if not unit:
        return [[]]
    return [[p, *rest] for p in names if unit.startswith(p) for rest in segmentations(unit[len(p):], names)]


@pytest.fixture(scope="module")
def pieces():
    return Pieces.of(VOCABULARY)


def test_trie_holds_what_can_occur(pieces):
    assert {b" ab", b"abc", b"\xc3\xa9", b"\xff", b"z"} <= set(pieces.names)
    assert not {b"C", b"1", b"b!"} & set(pieces.names)


def test_forward_sums_all_segmentations(pieces):
    rng = np.random.default_rng(4)
    logp = np.log(rng.dirichlet(np.ones(len(pieces.names)), 3).T)
    at = {p: i for i, p in enumerate(pieces.names)}
    words = ["a", "abca", "abcabc", "é", "caéb", "zab", "bbb"]
    units = [unit_of(w) for w in words]
    lattice = pieces.lattice(units)
    got, counts = lattice.marginals(logp), lattice.expected(logp[:, [1]])
    total = np.zeros(len(at))
    for u, row in zip(units, got):
        ways = [[at[p] for p in s] for s in segmentations(u, pieces.names)]
        probs = np.array([np.exp(logp[w].sum(0)) for w in ways])
        assert np.allclose(row, np.log(probs.sum(0)))
        for w, p in zip(ways, probs[:, 1] / probs[:, 1].sum()):
            np.add.at(total, w, p)
    assert np.allclose(np.bincount(lattice.piece, counts, len(at)), total)


def test_long_words_do_not_underflow(pieces):
    logp = np.full((len(pieces.names), 2), -math.log(len(pieces.names)))
    got = pieces.lattice([unit_of("z" * 3000), b" a"]).marginals(logp)
    assert np.allclose(got[0], -3001 * math.log(len(pieces.names)))


def test_words_are_letters():
    assert words_of("Ab-c12É é x_y ²") == ["ab", "c", "é", "é", "x", "y", "²"]
    assert [unit_of(w) for w in ("c", "²", "ⅷb")] == [b" c", b"", b" b"]


def test_one_round_of_counts(spark, pieces):
    rows = spark.createDataFrame([("x", "ab ab"), ("x", "abc"), ("y", "ca"), ("y", "b 7")], "lang string, text string")
    assert sorted(map(tuple, word_counts(rows, held_words=1).collect())) == [("x", "ab", 2), ("x", "abc", 1), ("y", "b", 1), ("y", "ca", 1)]
    model = fit_languages(rows, {"x": 2, "y": 2}, pieces, rounds=1, prior=2.0)
    want = np.zeros((len(pieces.names), 2))
    at = {p: i for i, p in enumerate(pieces.names)}
    for word, lang, n in (("ab", 0, 2), ("abc", 0, 1), ("ca", 1, 1), ("b", 1, 1)):
        ways = [[at[p] for p in s] for s in segmentations(unit_of(word), pieces.names)]
        weight = np.array([float(len(pieces.names)) ** -len(w) for w in ways])
        for w, p in zip(ways, weight / weight.sum()):
            np.add.at(want[:, lang], w, n * p)
    mean = (want / want.sum(0)).mean(1) + 1e-9
    mean /= mean.sum()
    assert np.allclose(np.exp(model.logp), (want + 2.0 * mean[:, None]) / (want.sum(0) + 2.0), atol=1e-5)


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = learn_languages(docs, fold_of("doc_id", 3).isin(0, 2))
    held = predict_language(docs.where(fold_of("doc_id", 3) == 1), model)
    n, right = held.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 300 and right / n >= 0.99
    again = predict_language(docs.where(fold_of("doc_id", 3) == 1).repartition(3), learn_languages(docs.repartition(5), fold_of("doc_id", 3).isin(0, 2)))
    assert sorted(dicts(held, "doc_id", "lang_pred", "score")) == sorted(dicts(again, "doc_id", "lang_pred", "score"))


def test_labels_outside_the_fold_are_not_read(spark):
    rng = random.Random(1)
    word = {"aa": "der die das und ich", "bb": "the and of that it"}
    rows = [(i, " ".join(rng.choices(word[lang].split(), k=8)), lang) for i in range(60) for lang in [rng.choice(["aa", "bb"])]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spoiled = docs.withColumn("lang", F.when(fold_of("doc_id", 3) == 1, F.lit("spoiled")).otherwise(F.col("lang")))
    model = learn_languages(spoiled, fold_of("doc_id", 3).isin(0, 2))
    assert model.langs == ["aa", "bb"]
    got = predict_language(docs, model).collect()
    assert all(r.lang == r.lang_pred and 0.5 < r.score <= 1 for r in got)


def test_rows_and_columns(spark, messy, nothing):
    docs = messy.withColumn("lang", F.when(F.col("source") == "a", "x").when(F.col("source") == "b", "y")).withColumn("lang_pred", F.lit("old"))
    model = learn_languages(docs, fold_of("doc_id", 3) >= 0)
    got = predict_language(docs, model)
    assert set(got.columns) == set(docs.columns) and got.count() == 11
    assert {(r.lang_pred, r.score) for r in got.collect() if not (r.text or "").strip()} == {("und", 0.0)}
    assert all(r.lang_pred in ("x", "y") and 0 <= r.score <= 1 for r in got.collect() if (r.text or "").strip())
    empty = with_clashes(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert learn_languages(empty, F.lit(True)) is None
    assert predict_language(nothing, model).count() == 0
    assert {r.lang_pred for r in predict_language(docs, None).collect()} == {"und"}
