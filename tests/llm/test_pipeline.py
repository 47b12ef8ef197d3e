"""The corpus pipeline against plain Python over the same documents."""

import re
from collections import Counter

import corpus_pipeline
from kiln.llm.decontaminate import normalise
from kiln.llm.mixing import mix_counts
from kiln.llm.quality import op8_quality_classifier
from tests.llm.conftest import dicts
from tests.llm.test_ngram import brute

SF = "/root/testdata/sf0.001"


def test_stages_filter_as_plain_python_does(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = dict(dicts(docs, "doc_id", "text"))
    good = {r.doc_id for r in op8_quality_classifier(spark, SF).collect() if r.score >= 0.5}
    first = {}
    for i in sorted(good):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text[i] or ""), i)
    exact = set(first.values())
    near = {c for _, _, c, _ in brute([(i, text[i]) for i in sorted(exact)], 5, 80)}

    def plain(t):
        return "".join(map(chr, normalise(t or "")[0]))
    items = [plain(t) for t, in dicts(spark.read.parquet(f"{SF}/benchmark.parquet"), "text")]
    clean = {i for i in near if not any(w in plain(text[i]) for w in items)}
    now, sizes = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns
        sizes.append({r.doc_id for r in now.collect()})
    assert sizes == [good, exact, near, clean] and len(clean) < len(near) < len(exact) < len(good) < len(text)
    copies = {r.doc_id: r.copies for r in mix_counts(now).collect()}
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*docs.columns, "epoch"]
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == Counter({i: n for i, n in copies.items() if n})
    assert all(r.text == text[r.doc_id] for r in rows)


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
