"""Benchmark decontamination against brute force."""

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from kiln.llm.decontaminate import Index, align, clean_documents, mark_leaks, normalise
from tests.llm.conftest import dicts, table

SF = "/root/testdata/sf0.01"


def _edits(p, t):
    """Fewest edits between all of p and any part of t."""
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, x in enumerate(t):
            new.append(min(row[j] + (c != x), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_banded_alignment_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        p = [rng.randint(1, 4) for _ in range(30)]
        q = list(p)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(q))
            q[k:k + rng.randint(0, 1)] = [9] * rng.randint(0, 1)
        ahead = rng.randint(0, 20)
        t = [rng.randint(5, 7) for _ in range(ahead)] + q + [rng.randint(5, 7) for _ in range(rng.randint(0, 9))]
        want = _edits(p, t)
        edits, start, end = align(np.array(p, np.uint32), np.array(t, np.uint32), ahead - 2, ahead + 2, 6)
        assert edits == want == _edits(p, t[start:end])


def _sentence(rng, n):
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_every_region_within_the_budget_is_found():
    """Random edits up to the budget, at places of our choice: the filter lets
    every such region pass, and nothing is reported above the budget."""
    rng = random.Random(3)
    items = [(i, _sentence(rng, 25)) for i in range(20)]
    index = Index(items, 96, 0.07)
    for _ in range(150):
        number = rng.randrange(len(index.segments))
        item, s, part, budget = index.segments[number]
        text = "".join(map(chr, part))
        for _ in range(rng.randint(0, budget)):
            k = rng.randrange(len(text))
            text = text[:k] + rng.choice(["", "x", text[k] + "y"]) + text[k + 1:]
        found = index.leaks(_sentence(rng, 30) + " " + text + " " + _sentence(rng, 30))
        assert any(f["item_id"] == item and f["segment"] == s for f in found)
        assert all(f["edits"] <= index.segments[number][3] for f in found if (f["item_id"], f["segment"]) == (item, s))
    assert not any(index.leaks(_sentence(rng, 300)) for _ in range(30))


def test_leaks_match_a_plain_search(spark):
    """On the test tables: documents that hold an item's normalised text."""
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))

    def plain(t):
        return "".join(map(chr, normalise(t or "")[0]))
    wanted = [(i, plain(t)) for i, t in dicts(items, "item_id", "text")]
    want = {(d, i) for d, t in dicts(docs, "doc_id", "text") for i, w in wanted if w in plain(t)}
    marked = mark_leaks(docs, items).select("doc_id", "leaks").collect()
    assert {(r.doc_id, x.item_id) for r in marked for x in r.leaks} == want and want
    blocks = mark_leaks(docs, items, block_chars=3000).select("doc_id", "leaks").collect()
    assert {(r.doc_id, x.item_id, x.start) for r in blocks for x in r.leaks} == {(r.doc_id, x.item_id, x.start) for r in marked for x in r.leaks}
    kept = {i for i, in dicts(clean_documents(docs, items), "doc_id")}
    assert kept == {r.doc_id for r in marked if not r.leaks}


def test_spans_are_of_the_original_text(spark):
    item = "The quick brown fox -- jumps over the lazy dog, while thirteen wizards quietly box in the garden of the old house."
    text = "é🙂 before.  " + item.upper().replace(" ", " \n ") + " after"
    got = mark_leaks(table(spark, [(1, text, "s")]), spark.createDataFrame([(7, item)], "item_id long, text string")).first().leaks
    assert [(x.item_id, x.edits, text[x.start:x.end]) for x in got] == [(7, 0, text[text.index("THE"):text.index(".", 20)])]


def test_messy_rows(spark, messy, nothing):
    items = spark.createDataFrame([(None, "one two three four five six"), (1, None), (2, ""), (3, "short"), (None, "one two three four five six")],
                                  "item_id long, text string")
    got = mark_leaks(messy, items)
    assert got.columns == messy.columns + ["leaks"] and got.count() == 11
    assert {r[0] for r in dicts(got.where("size(leaks) > 0"), "doc_id")} == {1, 2, None}
    assert mark_leaks(nothing, items).count() == 0 and mark_leaks(messy, items.limit(0)).where("size(leaks) > 0").count() == 0
    assert clean_documents(messy, items).columns == messy.columns


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB \t\n.é-İ🙂", max_size=30))
def test_normalised_offsets_point_at_their_letters(text):
    cp, at = normalise(text)
    assert len(cp) == len(at) and all(cp[i] == 32 or text[at[i]].isalnum() or text[at[i]] > "\uffff" for i in range(len(cp)))
    assert not len(cp) or (cp[0] != 32 and cp[-1] != 32 and not ((cp[1:] == 32) & (cp[:-1] == 32)).any())


def test_parts_of_items_are_found_wherever_they_begin(spark):
    """Verbatim parts of 80 normalised characters or more at random offsets, in clean
    text; parts of every length are planted, the clean texts stay clean."""
    rng = random.Random(5)
    items = [(i, "".join(map(chr, normalise(_sentence(rng, 40))[0]))) for i in range(60)]
    index = Index(items, 64, 0.07)
    for i, text in items:
        for share in (0.5, 0.6, 0.7, 0.8, 0.9):
            n = max(80, int(share * len(text)))
            a = rng.randrange(len(text) - n + 1)
            part = text[a:a + n]
            around = _sentence(rng, 30) + " ", " " + _sentence(rng, 30)
            whole = around[0] + part + around[1]
            found = [x for x in index.leaks(whole) if x["item_id"] == i]
            assert found and all(x["start"] < len(around[0]) + n and x["end"] > len(around[0]) for x in found)
            segments = {(x[0], x[1]): list(map(chr, x[2])) for x in index.segments}
            for x in found[:2]:
                assert _edits(segments[i, x["segment"]], re.sub(" +", " ", whole[x["start"]:x["end"]])) == x["edits"] <= 8
    assert not any(index.leaks(_sentence(rng, 300)) for _ in range(30))
    docs = table(spark, [(1, "ahead of it " + items[0][1][20:105] + " and after", "s"), (2, _sentence(rng, 60), "s")])
    assert dicts(clean_documents(docs, spark.createDataFrame(items, "item_id long, text string")), "doc_id") == [(2,)]


def test_what_was_found_by_equal_segments_is_listed_once():
    rng = random.Random(6)
    item = _sentence(rng, 60)
    index = Index([(1, item)], 64, 0.07)
    n = len(normalise(item)[0]) // 64
    assert [x["segment"] for x in index.new_leaks("x " + item + " y")] == list(range(n))
