from __future__ import annotations

import hashlib

import corpus_pipeline
from tests.llm.rows import documents, odd
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_near_dup import brute as brute_groups

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "near_duplicates", "benchmark_decontamination", "bpe_encoding"]
    at = docs
    for name in list(stages)[:-1]:
        before = sorted((r.doc_id, r.text) for r in at.collect())
        after = stages[name](spark, at, SF)
        assert after.columns == docs.columns
        at = corpus_pipeline.stage(after, "test")
        got = sorted((r.doc_id, r.text) for r in at.collect())
        if name == "quality_classifier":
            assert 0.6 * len(before) < len(got) < len(before) and set(got) <= set(before)
            continue
        if name == "line_dedup":
            want = [(i, t) for i, _, _, t in brute_lines(before)]
        elif name == "near_duplicates":
            groups = brute_groups([t for _, t in before])
            want = [row for k, row in enumerate(before) if groups[k][0] == k]
        else:
            hit = brute_hits([t for _, t in before], benchmark)
            want = [row for row, h in zip(before, hit) if not h[1]]
        assert got == want
    final = stages["bpe_encoding"](spark, at, SF).collect()
    text = dict(got)
    assert {r.doc_id: r.decoded_sha256 for r in final} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in text.items()}
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(tuple(r) for r in final)


def test_odd_rows(spark):
    for name, function in corpus_pipeline.STAGES:
        for docs in (odd(spark), documents(spark, [])):
            assert function(spark, docs, SF).count() <= docs.count(), name
