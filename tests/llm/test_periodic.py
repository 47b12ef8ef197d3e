"""Periodic runs against a plain search, on random, periodic and messy texts."""

import random

import numpy as np
import pytest

from kiln.llm.periodic import periodic_runs, planted, runs_of
from tests.llm.conftest import dicts, table


def plain(words, least, repeats=2):
    """Every maximal run: for each period, the stretches of words that equal the one a period later."""
    found = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, repeats * q) and j > i:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in found.items())


def text(rng):
    size, kind = rng.randint(0, 70), rng.random()
    if kind < 0.4:
        return [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(size)]
    if kind < 0.7:  # a block again and again, with words changed and pieces said twice
        words = ([rng.randrange(3) for _ in range(rng.randint(1, 9))] * 70)[:size]
        for _ in range(rng.randint(0, 2) if words else 0):
            words[rng.randrange(size)] = rng.randrange(4)
        at = rng.randrange(size) if words else 0
        return words[:at] + words[max(0, at - rng.randint(0, 3)):]
    a, b = [0], [0, 1]
    while len(b) < size:
        a, b = b, b + a
    return b[:size] + (b[:size][::-1] if rng.random() < 0.5 else [])


@pytest.mark.parametrize("least", [1, 4, 12])
def test_all_runs_are_found(least):
    rng = random.Random(least)
    for _ in range(500):
        texts = [text(rng) for _ in range(rng.randint(1, 4))]
        begin = np.cumsum([0] + [len(t) for t in texts])
        words = np.array([w for t in texts for w in t], np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        got = sorted(zip(*(a.tolist() for a in runs_of(words, doc, least, 2))))
        assert got == sorted((s + b, e + b, q) for t, b in zip(texts, begin.tolist()) for s, e, q in plain(t, least))


def test_a_shifted_phase_gives_runs_of_many_periods():
    words = [0, 1] * 40 + [0, 0] + [1, 0] * 40
    got = list(zip(*(a.tolist() for a in runs_of(np.array(words), np.zeros(len(words), np.int64), 12, 2))))
    assert sorted(got) == plain(words, 12) and len(got) > 30


def test_rows_and_columns(spark, messy, nothing):
    got = periodic_runs(messy)
    assert got.count() == 11 and periodic_runs(nothing).count() == 0
    answers = {r.doc_id: r for r in got.collect() if r.doc_id in (3, 4, 6, 7)}
    for i in (3, 4, 7):
        assert (answers[i].n_words, answers[i].n_runs, answers[i].start, answers[i].collapsed) == (0, 0, None, "")
    # 60,000 words in a cycle of 977, and one more word
    r = answers[6]
    assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 0, 60000, 977, 61412)
    assert r.collapsed == " ".join([f"word{i}" for i in range(977)] + ["end"])


def test_words_dropped_and_ties(spark):
    rows = [(1, "x " + "a b " * 6 + "y " + "c d " * 6, "s"), (2, "a " * 11, "s"), (3, "a\x85b " * 12 + "\xa0", "s"), (4, "a b " * 6 + "a", "s")]
    got = {r.doc_id: r for r in periodic_runs(table(spark, rows)).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period, got[1].collapsed) == (2, 1, 12, 2, "x a b y c d")
    assert got[2].n_runs == 0 and got[2].collapsed == "a " * 10 + "a"
    assert (got[3].period, got[3].collapsed) == (1, "a\x85b \xa0")  # other white space is part of a word
    assert (got[4].length, got[4].exponent_milli, got[4].collapsed) == (13, 6500, "a b")


def test_planted_repetition():
    words = [str(i).encode() for i in range(50)]
    changed = {i: planted(i, words) for i in range(200)}
    other = [i for i, w in changed.items() if w != words]
    assert 8 <= len(other) <= 35 and all(len(changed[i]) == 50 for i in other)
    assert planted(None, words) == words and planted(other[0], []) == []
