import pytest

import corpus_pipeline
from reviewmill.llm import decontaminate, minhash, toxicity
from reviewmill.llm.base import table

FOLDER = "/root/testdata/sf0.01"


def test_each_stage_on_the_rows_its_predecessor_kept(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_dedup", "decontamination", "mixing", "sharding"]
    stages = dict(corpus_pipeline.STAGES)

    clean = corpus_pipeline.stored(stages["toxicity"](spark, docs, FOLDER))
    model = toxicity.train(docs, table(spark, FOLDER, "labels"))
    low = {r.doc_id for r in docs.withColumn("p", toxicity.score_toxicity(docs, model)).collect() if r.p < 0.5}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == low

    single = corpus_pipeline.stored(stages["minhash_dedup"](spark, clean, FOLDER))
    groups = {r.doc_id: r.component_id for r in minhash.near_duplicates(clean).collect()}
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(set(groups.values()))

    fresh = corpus_pipeline.stored(stages["decontamination"](spark, single, FOLDER))
    items = [r.text for r in table(spark, FOLDER, "benchmark").collect()]
    words = [b" " + b" ".join(decontaminate.words_of(t)) + b" " for t in items]
    kept = {r.doc_id for r in fresh.collect()}
    for r in single.collect():
        whole = b" " + b" ".join(decontaminate.words_of(r.text)) + b" "
        assert (r.doc_id in kept) == (not any(w in whole for w in words))
    assert fresh.columns == columns

    mixed = corpus_pipeline.stored(stages["mixing"](spark, fresh, FOLDER))
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} <= kept
    total = sum(len(r.text.split()) for r in fresh.collect())
    assert sum(len(r.text.split()) for r in mixed.collect()) == pytest.approx(1.5 * total, rel=0.05)

    shards = corpus_pipeline.stored(stages["sharding"](spark, mixed, FOLDER))
    assert shards.count() == mixed.count() and shards.select("shard").distinct().count() == 40


def test_run_starts_from_documents(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert "shard" in found.columns and found.count() > 0
