"""N-gram Jaccard join and its parts against brute force."""

import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.llm.common import frozen
from kiln.llm.graph import components
from kiln.llm.ngram_join import block_links, few_labels, jaccard_components, may_link, near_dedup, overlaps, parity, shingles, smallest_reachable
from tests.llm.conftest import dicts, table


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def _set(text, k):
    w = [x for x in _lower(text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    """{row number: (n, component id, links)} of (id, text) rows."""
    sets = [_set(t, k) for _, t in rows]
    near = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                near[i].add(j)
                near[j].add(i)
    label = {}
    for i in range(len(rows)):
        if i not in label:
            todo, own = [i], {i}
            while todo:
                new = near[todo.pop()] - own
                own |= new
                todo += new
            ids = [rows[j][0] for j in own if rows[j][0] is not None]
            for j in own:
                label[j] = min(ids) if ids else None
    return [(rows[i][0], len(sets[i]), label[i], len(near[i])) for i in range(len(rows))]


def _corpus(seed, n=160):
    """Families of near copies that drift, exact copies, a frequent passage and
    very short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(12))
    rows = []
    while len(rows) < n:
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 6, 30, 60]))]
        if rng.random() < 0.5:
            words += passage.split()
        for _ in range(rng.choice([1, 1, 2, 8])):
            rows.append((len(rows), " ".join(words)))
            if words and rng.random() < 0.7:
                k = rng.randrange(len(words))
                words[k:k + rng.randint(0, 1)] = [rng.choice(vocabulary)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(order[i], t.upper() if i % 5 == 0 else t) for i, t in rows]


def _got(df):
    return sorted(dicts(df, "doc_id", "n_shingles", "component_id", "n_links"), key=repr)


def test_components_match_brute_force(spark):
    for seed, k, percent in ((1, 4, 85), (2, 5, 80), (3, 2, 60)):
        rows = _corpus(seed)
        docs = table(spark, [(i, t, "s") for i, t in rows])
        assert _got(jaccard_components(docs, k, percent)) == sorted(brute(rows, k, percent), key=repr)


def test_large_components_are_cut_into_pairs_of_chunks(spark):
    """The same result where blocks hold a few documents, and where all shingles
    share eight counters, so that their order says little."""
    rows = _corpus(7)
    docs = table(spark, [(i, t, "s") for i, t in rows])
    want = sorted(brute(rows, 3, 70), key=repr)
    assert _got(jaccard_components(docs, 3, 70, block_docs=6, sketch=64, list_docs=4)) == want
    assert _got(jaccard_components(docs, 3, 70, block_shingles=90)) == want


def test_messy_rows(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    assert _got(jaccard_components(messy, 4, 85)) == sorted(brute(rows, 4, 85), key=repr)
    assert jaccard_components(nothing).count() == 0 and near_dedup(nothing).count() == 0
    kept = near_dedup(messy)
    assert kept.columns == messy.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, [1, 3, 4, 5, 5, 7, None]))


def test_near_dedup_keeps_one_of_each_component(spark):
    rows = _corpus(11)
    docs = table(spark, [(i, t, "s") for i, t in rows])
    assert sorted(i for i, in dicts(near_dedup(docs), "doc_id")) == sorted({c for _, _, c, _ in brute(rows, 5, 80)})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 25), min_size=1, max_size=12), min_size=1, max_size=12), st.integers(0, 6))
def test_products_count_shared_shingles(lists, dense_from):
    sets = [np.unique(np.array(x, np.uint64)) for x in lists]
    got = overlaps(sets, dense_from=dense_from, columns=4, flush=5)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(set(a.tolist()) & set(b.tolist()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(1, 300)), min_size=2, max_size=8), st.integers(50, 95))
def test_parities_let_every_link_pass(ranges, percent):
    mix = np.random.default_rng(0).integers(0, 1 << 63, 700, dtype=np.uint64)
    sets = [np.unique(mix[a:a + n]) for a, n in ranges]
    links = block_links(sets, percent)
    sigs, n, ids = [parity(s) for s in sets], [len(s) for s in sets], list(range(50, 50 + len(sets)))
    may = may_link(sigs, np.array(n), percent)
    assert not (links & ~may).any()
    assert few_labels(ids, n, sigs, percent) == smallest_reachable(may, np.array(ids)).tolist()


def test_labels_reach_along_chains():
    sets = [np.arange(i, i + 20, dtype=np.uint64) for i in range(0, 40, 2)]
    links = block_links(sets, 80)
    assert (smallest_reachable(links, np.arange(100, 120)) == 100).all() and not links[0, 2]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAéÉ \t\n\x0b\xa0 ", max_size=30), st.integers(1, 5))
def test_shingles_are_as_many_as_runs_of_words(text, k):
    assert len(shingles(text, k)) == len(_set(text, k))


def test_components_of_a_graph(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    got = dict(dicts(components(spark.createDataFrame(pairs, "a long, b long")), "node", "label"))
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: find(x) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_unrelated_sets_may_not_link_beside_a_small_one():
    """Parities were folded to the bins of the smallest set of a list, and a set had half as many bins
    as shingles: most pairs of unrelated large sets passed, and their candidate components grew together."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (40, *range(700, 712), *[1020] * 100)]
    sigs, n, ids = [parity(s) for s in sets], [len(s) for s in sets], list(range(len(sets)))
    assert not may_link(sigs, np.array(n), 80).any()
    assert few_labels(ids[:10], n[:10], sigs[:10], 80) == ids[:10]


def test_what_is_stored_keeps_no_shuffle_files(spark):
    statuses = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = set(statuses.keySet().mkString(",").split(","))
    rows = frozen(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    assert set(statuses.keySet().mkString(",").split(",")) <= before and rows.count() == 10
