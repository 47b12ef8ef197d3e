"""Substring dedup: chunks, and passages found against brute force."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from kiln.llm.substring_dedup import _cut, _digest, chunks, repeated_spans, selected
from tests.llm.conftest import dicts, table

SF = "/root/testdata/sf0.01"


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=300), st.text(max_size=40))
def test_chunks_cover_the_text_and_resist_a_shift(text, ahead):
    bounds, digests, words = chunks(text, 8)
    assert bounds[0] == 0 and bounds[-1] == len(text) and (np.diff(bounds) > 0).all() and len(digests) == len(bounds) - 1
    moved = chunks(ahead + text, 8)
    own = {(int(a) + len(ahead), int(b) + len(ahead)) for a, b in zip(bounds, bounds[1:]) if a >= 16 and len(set(digests.tolist())) == len(digests)}
    assert own <= set(zip(moved[0].tolist(), moved[0][1:].tolist()))


def test_equal_chunks_have_equal_digests_and_others_not():
    rng = random.Random(2)
    seen = {}
    for _ in range(300):
        text = "".join(rng.choice("abcdé ") for _ in range(200))
        bounds, digests, _ = chunks(text, 6)
        for a, b, d in zip(bounds, bounds[1:], digests.tolist()):
            assert seen.setdefault(d, text[a:b]) == text[a:b]


def test_passages_of_over_50_words_are_found(spark):
    """Against all runs of 51 words that two documents share; texts that say one
    word again and again have no bounds to find."""
    rows = [(i, t) for i, t in dicts(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text")]
    owner, want, any_ = {}, set(), {}
    for i, t in rows:
        w = (t or "").split()
        for n, seen, out in ((51, owner, want), (15, any_, None)):
            for k in range(len(w) - n + 1):
                run = tuple(w[k:k + n])
                if n == 51 and len(set(run)) < 25:
                    continue
                j = seen.setdefault(run, {i} if n == 15 else i)
                if n == 15:
                    j.add(i)
                elif j != i:
                    out |= {i, j}
    short = {i for docs in any_.values() if len(docs) > 1 for i in docs}
    got = repeated_spans(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    found = {r.doc_id for r in got}
    assert len(want) > 50 and not want - found and not found - short
    texts = dict(rows)
    for r in got:
        assert abs(len(texts[r.doc_id][r.start:r.end].split()) - r.n_words) <= 1 and r.first_id <= r.doc_id
        assert r.removed == (r.first_id < r.doc_id)


def test_messy_rows(spark, messy, nothing):
    got = repeated_spans(messy)
    assert got.columns == ["doc_id", "start", "end", "n_words", "first_id", "removed"]
    assert {r.doc_id for r in got.collect()} == {5, 6} and repeated_spans(nothing).count() == 0
    rng = random.Random(4)
    long_text = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80))
    # rows that share an id are one document; rows without an id are told apart by their text
    rows = [(1, long_text, "s"), (1, long_text + " x", "s"), (2, None, "s"), (3, "", "s")]
    assert repeated_spans(table(spark, rows)).count() == 0
    rows = [(None, long_text, "s"), (None, long_text + " x", "s")]
    assert repeated_spans(table(spark, rows)).count() == 2


def test_one_holder_of_a_passage_keeps_it_and_clean_documents_are_not_reported(spark):
    """All texts are made of the same few phrases, so that nearly every chunk of a
    passage occurs in earlier documents that do not hold it."""
    rng = random.Random(7)
    phrases = [" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(6)) for _ in range(40)]

    def say(n):
        return " ".join(rng.choice(phrases) for _ in range(n))
    docs = {i: say(40) for i in range(100)}
    a, b = say(12), say(12)
    held = {a: [110, 120, 130], b: [115, 120, 125]}
    for i in {i for who in held.values() for i in who}:
        docs[i] = " ".join([say(6), *[p + " " + say(6) for p, who in held.items() if i in who]])
    runs = {}
    for i, t in docs.items():
        w = t.split()
        for k in range(len(w) - 23):
            runs.setdefault(tuple(w[k:k + 24]), set()).add(i)
    shared = {i for who in runs.values() if len(who) > 1 for i in who}
    got = repeated_spans(table(spark, [(i, t, "s") for i, t in docs.items()])).collect()
    assert {r.doc_id for r in got} <= shared and len(shared) < 40
    left = dict(docs)
    for r in sorted(got, key=lambda r: -r.start):
        if r.removed:
            left[r.doc_id] = left[r.doc_id][:r.start] + left[r.doc_id][r.end:]
    for passage, who in held.items():
        assert [i for i in who if passage in left[i]] == who[:1]


def test_spans_of_sf01_are_verbatim_in_their_first_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = dict(dicts(docs, "doc_id", "text"))
    got = repeated_spans(docs).collect()
    assert sum(not r.removed for r in got) > 500
    for r in got:
        if r.removed:
            span, first = texts[r.doc_id][r.start:r.end].split(" "), texts[r.first_id]
            assert r.n_words >= 25 and any(" ".join(span[k:k + 15]) in first for k in range(1, len(span) - 15))


def _sharing(texts, n):
    """Documents that share a run of n words with another, by a rolling number of words."""
    number, runs, owner = {}, [], []
    for i, t in texts.items():
        w = np.array([number.setdefault(x, len(number) + 1) for x in t.split()], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        w ^= w >> np.uint64(29)
        h = np.zeros(max(0, len(w) - n + 1), np.uint64)
        for k in range(n):
            h = h * np.uint64(1099511628211) + w[k:k + len(h)]
        runs.append(np.unique(h))
        owner.append(np.full(len(runs[-1]), i))
    h, d = np.concatenate(runs), np.concatenate(owner)
    order = np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    same = np.zeros(len(h), bool)
    same[1:] |= h[1:] == h[:-1]
    same[:-1] |= h[1:] == h[:-1]
    return set(d[same].tolist())


def test_every_document_with_a_shared_run_of_51_words_is_found(spark):
    """Also those that say one word again and again; none without a shared run of 20 words."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = {i: t or "" for i, t in dicts(docs, "doc_id", "text")}
    found = {r.doc_id for r in repeated_spans(docs).select("doc_id").distinct().collect()}
    assert len(_sharing(texts, 51)) > 2000
    assert not _sharing(texts, 51) - found and not found - _sharing(texts, 20)


def test_phrases_said_again_and_again(spark):
    rng = random.Random(9)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(n))
    docs, want = {}, set()
    for k in range(60):
        phrase = words(rng.randint(1, 3))
        for j in range(2):
            docs[2 * k + j] = f"{words(rng.randint(0, 30))} {' '.join([phrase] * rng.randint(60, 80))} {words(rng.randint(0, 30))}"
            want.add(2 * k + j)
    docs |= {1000 + k: words(200) for k in range(20)}
    got = repeated_spans(table(spark, [(i, t, "s") for i, t in docs.items()]))
    assert {r.doc_id for r in got.collect()} == want


def test_selected_stretches_are_least_of_a_window():
    rng = random.Random(3)
    for _ in range(40):
        text = " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 150)))
        bounds, words, within, total = _cut(text, 12)
        on = {}
        for i, (w, inside) in enumerate(zip(words, within)):
            later = [j for j in range(len(bounds)) if words[j] >= w - inside + 8]
            if later:
                on[i] = int(_digest(total, bounds[[i]], bounds[[later[0]]])[0])
        want = {min(d for j, d in on.items() if j >= i and words[j] < words[i] + 5) for i in on}
        assert set(selected(text, 12, 8, 5).tolist()) == want


def test_text_ids_and_spans(spark):
    """first_id is an id, the smallest in the order of texts; spans against all runs of words."""
    rng = random.Random(12)

    def words(n):
        return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(n)]
    shared = [words(70) for _ in range(6)]
    docs, at = {}, {}
    for k in range(24):
        name, body = f"doc{k}", words(rng.randint(5, 60))
        p = rng.randrange(6)
        at[name] = (p, len(body), len(body) + 70)
        docs[name] = body + shared[p] + words(rng.randint(5, 60))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()] + [(None, " ".join(words(10) + shared[0]))], "doc_id string, text string")
    got = [r for r in repeated_spans(df).collect() if r.doc_id is not None]
    holders = {p: sorted(n for n, (q, *_) in at.items() if q == p) for p in range(6)}
    want = {n for who in holders.values() if len(who) > 1 for n in who} | set(holders[0])
    assert {r.doc_id for r in got} == want
    # two later documents may have a bound in common that the first has not, near an end: a piece of its own
    whole = [r for r in got if r.n_words >= 25]
    assert len(whole) == len(want) and all(r.n_words <= 15 and not r.removed for r in got if r.n_words < 25)
    for r in whole:
        p, a, z = at[r.doc_id]
        text = " ".join(docs[r.doc_id])
        begin, end = len(text[:r.start].split()), len(text[:r.end].split())
        # inside the passage, but for the word next to it that ends alike; short of it by one chunk or two on each side
        assert a - 1 <= begin <= a + 20 and z - 20 <= end <= z + 1
        assert r.first_id == holders[p][0] and r.removed == (r.doc_id != holders[p][0])
    lone = [r for r in repeated_spans(df).collect() if r.doc_id is None]
    assert len(lone) == 1 and lone[0].first_id == holders[0][0]
