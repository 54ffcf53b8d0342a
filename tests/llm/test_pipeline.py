from __future__ import annotations

import corpus_pipeline
from cellarium.llm import decontaminate, mixing, quality
from cellarium.llm.common import table
from cellarium.plans.scratch import settle
from tests.llm.test_near_copies import plain_classes

DATA = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark):
    docs = table(spark, DATA, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "benchmark_decontamination", "source_mixing", "token_output"]
    bench = table(spark, DATA, "benchmark")

    kept = {r["doc_id"] for r in quality.judge(docs).where("kept").select("_doc.doc_id").collect()}
    good = docs.where(docs.doc_id.isin(*kept))
    texts = sorted((r["doc_id"], r["text"]) for r in good.collect())
    one = {texts[k][0] for k in plain_classes([text for _, text in texts])}
    apart = good.where(good.doc_id.isin(*one))
    dirty = {r["doc_id"] for r in decontaminate.overlaps(apart, bench).collect()}
    clean = apart.where(~apart.doc_id.isin(*dirty)) if dirty else apart
    rows = mixing.mixed(clean).collect()

    found = corpus_pipeline.run(spark, DATA).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(r["doc_id"] for r in rows)
    starts = sorted((r["start"], r["n_tokens"]) for r in found)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:k]) for k in range(len(starts))]


def test_columns_stay_those_of_documents(spark):
    docs = table(spark, DATA, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, DATA), "result", outlive=True)
        assert docs.dtypes == table(spark, DATA, "documents").dtypes
