import os

import pytest

import corpus_pipeline
from docweave.llm import toxicity
SMALL = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    now, before = docs, docs.count()
    model = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).filter("predicted = 1").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.saved(stage(spark, now, SMALL))
        assert now.columns == docs.columns and now.count() <= before
        before = now.count()
        if name == "toxicity":
            assert {r.doc_id for r in now.select("doc_id").collect()} == {r.doc_id for r in docs.collect()} - toxic
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, SMALL).toPandas()
    assert set(pieces.doc_id) == {r.doc_id for r in now.select("doc_id").collect()}


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_edge_rows(spark, stage):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word " * 30_000, None, "s", None)],
                                 spark.read.parquet(f"{SMALL}/documents.parquet").schema)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SMALL)
    assert out.count() >= 2
    assert corpus_pipeline.STAGES[stage][1](spark, docs.limit(0), SMALL).count() == 0


def test_run(spark):
    assert os.path.exists(corpus_pipeline.__file__)
    assert corpus_pipeline.run(spark, SMALL).count() > 0
