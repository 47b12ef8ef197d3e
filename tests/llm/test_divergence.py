"""Source divergence against plain Python, and its skyband against counting all dominators."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from kiln.llm.divergence import Band, divergence_audit, share, share_of, skyband, term_counts
from tests.llm.conftest import with_clashes


def plain_audit(rows, min_docs=3, top=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = ["".join(c.lower() if c.isascii() else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def shares(gs):
            c = {t: sum(counts[g][t] for g in gs) for t in kept}
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // total for t in kept}, c
        mine = [g for g in groups if g[0] == lang]
        p, c = shares([(lang, source)])
        q, _ = shares(mine)
        pairs = [(other, sum((p[t] - o[t]) ** 2 // o[t] for t in kept)) for _, other in mine if other != source for o in [shares([(lang, other)])[0]]]
        leading = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if c[t] > 0 and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", leading, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def corpus(rng, n):
    words = [f"w{chr(97 + i % 26)}{'xyz'[i % 3]}" * (1 + i % 2) for i in range(60)] + ["Émile", "ÉMILE", "straße", "日本", "𝒳", "İ"]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["a", "b", "", "ü", None]),
             " ".join(rng.choice([str.upper, str])(rng.choice(words[:rng.randint(1, len(words))])) for _ in range(rng.randint(0, 30)))) for _ in range(n)]
    return rows + [("en", "no words", "1 2 3"), ("en", "no text", None), ("xx", "lone", "once"), ("yy", "one", ""), ("yy", "two", "?!")] + rows[:5]


def frame(spark, rows):
    return with_clashes(spark.createDataFrame(rows, "lang string, source string, text string").withColumn("n", F.lit(0)).withColumn("terms", F.lit("x")))


def test_audit_equals_plain_python(spark):
    for seed, top in ((1, 200), (2, 5)):
        rows = corpus(random.Random(seed), 120)
        got = divergence_audit(frame(spark, rows).repartition(7), top=top)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, top=top)


def test_empty_and_long(spark):
    assert divergence_audit(frame(spark, [])).count() == 0
    long_text = " ".join(f"t{i % 5000:x}".replace("0", "g") for i in range(200_000)) + " " + "é" * 100_000
    rows = [("en", s, long_text) for s in ("a", "b", "b")] + [("en", "c", "tg")]
    assert sorted(tuple(r) for r in divergence_audit(frame(spark, rows), top=3).collect()) == plain_audit(rows, top=3)


def test_parts_of_a_term_add_up(spark):
    rows = corpus(random.Random(3), 60)
    whole, parts = (term_counts(frame(spark, rows), held_terms=h).groupBy("lang", "source", "term").agg(F.sum("n"), F.sum("docs")).collect()
                    for h in (10 ** 6, 3))
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parts)) and whole


def _brute_band(rows, k):
    return {r for r in rows if sum(o != r and o[0] >= r[0] and o[1] <= r[1] and o[2].encode() < r[2].encode() for o in rows) < k}


def test_skyband_counts_all_dominators(spark):
    rng = random.Random(5)
    rows = [(rng.choice("gh"), min(int(rng.paretovariate(0.7)), 10 ** 6), t) for t in {"".join(rng.choices("abcé𝒳", k=4)) for _ in range(700)}]
    rows = [(g, n, n + int(rng.paretovariate(0.6)) % 50, t) for g, n, t in rows]
    df = spark.createDataFrame(rows, "g string, higher long, lower long, text string").repartition(5)
    for k in (1, 4, 30):
        got = [tuple(r) for r in skyband(df, ["g"], "higher", "lower", "text", k, part_rows=90).collect()]
        want = {(g, *r) for g in "gh" for r in _brute_band([x[1:] for x in rows if x[0] == g], k)}
        assert len(got) == len(set(got)) and set(got) == want


def test_band_in_large_blocks():
    rng = np.random.default_rng(1)
    n, k = 20_000, 20
    higher, lower, place = rng.zipf(1.3, n) % 1000, rng.integers(0, 5000, n), rng.permutation(n)
    order = np.lexsort((place, lower, -higher))
    lo, pl = lower[order], place[order]
    keep = Band(k).admit(lo, pl)
    pick = rng.choice(n, 500, replace=False)
    want = [((lo[:i] <= lo[i]) & (pl[:i] < pl[i])).sum() < k for i in pick]
    assert keep[pick].tolist() == want and keep.sum() < n / 4


def test_shares_beyond_63_bits(spark):
    n, total = 10 ** 13, 3 * 10 ** 13 + 7
    want = 1 + 10 ** 9 * (n + 1) // total
    assert share(np.array([n]), total).tolist() == [want]
    df = spark.createDataFrame([(n, total)], "n long, t long")
    assert df.select(share_of("n", F.col("t"))).first()[0] == want


def test_pair_sums_grow_with_the_terms_not_with_the_tasks(spark):
    from kiln.llm.divergence import kept_terms, pair_values, term_counts
    rows = [(i, f"w{i % 7} w{i % 5} x", "en", f"s{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    terms = kept_terms(term_counts(df), 1).localCheckpoint()
    words = terms.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source")).agg(F.sum("s.n").alias("n"))
    heads = (words.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("sources"))
                  .join(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms")), "lang").select("lang", "terms", "sources"))
    few, many = pair_values(terms, heads, 64), pair_values(terms, heads, 64, cells=1)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) and few.count() == 6
    one, each = ("rangepartitioning(part" in d._jdf.queryExecution().executedPlan().toString() for d in (few, many))
    assert each and not one
