"""Toxicity: a weighted lexicon learned from labels, matched by Aho-Corasick in
folded text, normalised by length, with exception phrases."""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import defaultdict
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import table
from kiln.llm.registry import query
from kiln.llm.sample import fold_of, labelled_texts

# Letters that look like Latin ones, and digits or signs that stand
# for letters; i, l and 1 are one letter.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɡ": "g", "ɑ": "a", "ʟ": "l",
}
_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "l": "i"}
_FOLD = {ord(k): _SIGNS.get(v, v) for k, v in (_LOOKALIKES | _SIGNS).items()}
_FOLD |= {c: None for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in _SIGNS}
_FOLD |= {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)}
_WIDE = re.compile("[̀-ͯ！-～\U0001d400-\U0001d7ff①-⓿]")
#: Signs at the end of a word are not letters.
_TAIL = re.compile(r"[@$]+(?=\s|$)")


def fold(text: str) -> list[str]:
    """Words of a text in the form in which they are matched."""
    if _WIDE.search(text):
        text = unicodedata.normalize("NFKC", text)
    if "$" in text or "@" in text:
        text = _TAIL.sub("", text)
    return text.lower().translate(_FOLD).split()


def features(words) -> set[str]:
    """Candidates for the lexicon in a text: starts of 3 to 8 letters of its words
    (" abc") and whole words (" abcd ")."""
    out = set()
    for w in set(words):
        out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in range(3, min(8, len(w)) + 1))
    return out


@dataclass(frozen=True)
class ToxicModel:
    """Weights of the patterns, exception phrases, and the logistic curve over
    the normalised sum of weights."""
    weights: dict
    exceptions: tuple
    slope: float
    offset: float

    def automaton(self):
        a = ahocorasick.Automaton()
        for p, w in self.weights.items():
            a.add_word(p, (p, w))
        for p in self.exceptions:
            a.add_word(p, (p, None))
        if len(a):
            a.make_automaton()
        return a


def hits(automaton, words: list[str]) -> dict[str, float]:
    """Distinct patterns that occur outside the exception phrases, with weights."""
    if not len(automaton) or not words:
        return {}
    joined = f" {' '.join(words)} "
    found, spared = [], []
    for end, (p, w) in automaton.iter(joined):
        if w is None:
            spared.append((end - len(p) + 1, end))
        else:
            found.append((end - len(p) + 1, p, w))
    if spared:
        found = [x for x in found if not any(a <= x[0] < b for a, b in spared)]
    return {p: w for _, p, w in found}


def strength(found: dict[str, float], n_words: int) -> float:
    """Sum of the distinct patterns' weights, less for a longer text."""
    return sum(found.values()) / math.log2(8 + n_words)


def _feature_counts(texts: DataFrame) -> DataFrame:
    """(f, pos, neg): distinct texts with each candidate, by label."""
    def words(batches):
        for b in batches:
            for t, y in zip(b.column("_text"), b.column("_y").to_pylist()):
                fs = list(features(fold(t.as_py())))
                yield pa.RecordBatch.from_pydict({"f": fs, "y": pa.array([y] * len(fs), pa.float64())})
    return (texts.dropDuplicates(["_text"]).mapInArrow(words, "f string, y double")
                 .groupBy("f").agg(F.sum(F.when(F.col("y") > 0, 1).otherwise(0)).alias("pos"),
                                   F.sum(F.when(F.col("y") > 0, 0).otherwise(1)).alias("neg")))


def _families(words: list[str]) -> list[int]:
    """Three min-hashes of the words: near copies of a text mostly share each."""
    return [min((zlib.crc32(w.encode("utf-8", "replace"), seed) for w in set(words)), default=0) for seed in (1, 2, 3)]


def choose(rated: dict, families: dict, min_families: int) -> dict:
    """Lexicon out of the candidates ``rated`` (pattern -> (toxic texts, clean texts,
    weight)). A candidate counts if its toxic texts are of ``min_families``
    families or more, so that copies of one text make none. Of candidates that
    continue one another it takes the shortest, then follows those that keep nine
    tenths of its toxic texts, to the longest such start of a word."""
    good = {f for f in rated if families.get(f, 0) >= min_families}
    longer = defaultdict(list)
    for f in good:
        longer[f[:-1]].append(f)
    lexicon = {}
    for f in sorted(good):
        if f[:-1] in good or (f[-1] == " " and f[:9].rstrip() in good):
            continue
        while nxt := [c for c in longer[f] if c[-1] != " " and rated[c][0] >= 0.9 * rated[f][0]]:
            f = max(nxt, key=lambda c: (rated[c][0], c))
        lexicon[f] = rated[f][2]
    return lexicon


def fit_toxic(texts: DataFrame, min_families: int = 6, min_odds: float = 20.0, doubtful_odds: float = 3.0) -> ToxicModel | None:
    """Model from labelled texts (``labelled_texts``: a bounded sample). None
    without labelled rows of both kinds.

    A candidate's weight is the logarithm of how many times likelier it is in a
    toxic text than in a clean one. Those in ``min_families`` toxic texts or more
    and at least ``min_odds`` times likelier may enter the lexicon (``choose``).
    A word next to a lexicon word that occurs with it only in clean texts, in three
    or more, makes an exception phrase. Whole words that are only ``doubtful_odds``
    times likelier, in three times as many toxic texts, enter if they reach
    ``min_odds`` outside such phrases. Counting is distributed; the driver holds
    the candidates of the sample's toxic texts.
    """
    held = texts.select("_id", "_text", "_y").persist()
    try:
        n_pos, n_neg = held.agg(F.sum(F.when(F.col("_y") > 0, 1).otherwise(0)), F.sum(F.when(F.col("_y") > 0, 0).otherwise(1))).first()
        if not n_pos or not n_neg:
            return None
        odds = (F.col("pos") + 0.5) / (n_pos + 1.0) / ((F.col("neg") + 0.5) / (n_neg + 1.0))
        doubt = F.col("f").endswith(" ") & (F.col("pos") >= 3 * min_families) & (F.col("w") >= math.log(doubtful_odds))
        likely = (_feature_counts(held).withColumn("w", F.log(odds))
                  .where((F.col("pos") >= min_families) & ((F.col("w") >= math.log(min_odds)) | doubt)))
        rated = {r.f: (r.pos, r.neg, r.w) for r in likely.collect()}
        known = frozenset(rated)

        def candidates(batches):
            for b in batches:
                ws = [fold(t.as_py()) for t in b.column("_text")]
                yield pa.RecordBatch.from_pydict({"fs": pa.array([sorted(features(w) & known) for w in ws], pa.list_(pa.string())),
                                                  "hs": pa.array([_families(w) for w in ws], pa.list_(pa.int64()))})
        own = defaultdict(lambda: (set(), set(), set()))
        for r in held.where("_y > 0").dropDuplicates(["_text"]).select("_text").mapInArrow(candidates, "fs array<string>, hs array<long>").collect():
            for f in r.fs:
                for seen, h in zip(own[f], r.hs):
                    seen.add(h)
        families = {f: min(map(len, seen)) for f, seen in own.items()}
        sure = {f: v for f, v in rated.items() if v[2] >= math.log(min_odds)}
        lexicon = choose(sure, families, min_families)
        sure_ones = ToxicModel(lexicon, (), 0.0, 0.0).automaton()
        doubtful = {f: v[2] for f, v in rated.items() if f not in sure and families.get(f, 0) >= 3 * min_families and not hits(sure_ones, f.split())}
        plain = ToxicModel(lexicon | doubtful, (), 0.0, 0.0)

        def contexts(batches):
            a = plain.automaton()
            for b in batches:
                out = defaultdict(list)
                for t, y in zip(b.column("_text"), b.column("_y").to_pylist()):
                    ws = fold(t.as_py())
                    if hits(a, ws):
                        bad = {w for w in set(ws) if hits(a, [w])}
                        near = {f" {x} {z} " for x, z in zip(ws, ws[1:]) if x in bad or z in bad}
                        out["f"] += near
                        out["y"] += [y] * len(near)
                yield pa.RecordBatch.from_pydict({"f": pa.array(out["f"], pa.string()), "y": pa.array(out["y"], pa.float64())})
        toxic, clean = F.sum(F.when(F.col("y") > 0, 1).otherwise(0)), F.sum(F.when(F.col("y") > 0, 0).otherwise(1))
        unique = held.dropDuplicates(["_text"]).select("_text", "_y")
        near = unique.mapInArrow(contexts, "f string, y double").groupBy("f").agg(toxic.alias("pos"), clean.alias("neg"))
        spared = ToxicModel(plain.weights, tuple(sorted(r.f for r in near.where("pos = 0 AND neg >= 3").collect())), 0.0, 0.0)

        def left(batches):
            a = spared.automaton()
            for b in batches:
                rows = [(f, y) for t, y in zip(b.column("_text"), b.column("_y").to_pylist()) for f in hits(a, fold(t.as_py()))]
                yield pa.RecordBatch.from_pydict({"f": pa.array([r[0] for r in rows], pa.string()), "y": pa.array([r[1] for r in rows], pa.float64())})
        again = unique.mapInArrow(left, "f string, y double").groupBy("f").agg(toxic.alias("pos"), clean.alias("neg")).withColumn("w", F.log(odds))
        weights = {r.f: r.w for r in again.where(F.col("w") >= math.log(min_odds)).collect()}
        lexicon = {f: weights[f] for f in plain.weights if f in weights}
        used = ToxicModel(lexicon, (), 0.0, 0.0).automaton()
        exceptions = tuple(p for p in spared.exceptions if any(hits(used, [w]) for w in p.split()))
        model = ToxicModel(lexicon, exceptions, 0.0, 0.0)

        def strengths(batches):
            a = model.automaton()
            for b in batches:
                ws = [fold(t.as_py()) for t in b.column("_text")]
                yield pa.RecordBatch.from_pydict({"x": pa.array([strength(hits(a, w), len(w)) for w in ws], pa.float64()), "y": b.column("_y")})
        got = sorted(held.select("_text", "_y").mapInArrow(strengths, "x double, y double").groupBy("x", "y").count().collect())
        slope, offset = logistic(*(np.array([r[i] for r in got], float) for i in range(3)))
        return ToxicModel(lexicon, exceptions, slope, offset)
    finally:
        held.unpersist()


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, penalty: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve over points that occur ``n`` times each, by Newton's method."""
    z, b = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        w = n * (p * (1 - p) + 1e-9)
        step = np.linalg.solve((z * w[:, None]).T @ z + penalty * np.eye(2), z.T @ (n * (y - p)) - penalty * b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def score_toxic(docs: DataFrame, model: ToxicModel | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text added or replaced; null
    and empty texts have no hit and get the score of such. Without a model it is
    0. Rows pass one by one; repeated rows get the same score."""
    names = [c for c in docs.columns if c != name]
    kept = docs.select(*names)
    if model is None:
        return kept.withColumn(name, F.lit(0.0))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + f", `{name}` double"

    def score(batches):
        a = model.automaton()
        for b in batches:
            xs = []
            for t in b.column(text_col):
                words = fold(t.as_py() or "")
                xs.append(strength(hits(a, words), len(words)))
            z = np.clip(np.array(xs, dtype=float) * model.slope + model.offset, -30, 30)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-z)), pa.float64())], names=[*names, name])
    return kept.mapInArrow(score, schema)


def toxic_model(docs: DataFrame, labels: DataFrame, max_rows: int = 20000) -> ToxicModel | None:
    """Model of ``labels.toxic``, from labels outside the held-out fold (crc32 of
    the id mod 5 = 0), about ``max_rows`` of them."""
    return fit_toxic(labelled_texts(docs, labels, "toxic", fold_of("doc_id", 5) != 0, max_rows))


@query("op5_toxicity")
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxic(docs, toxic_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
