"""The pipeline's stages, each on what the one before it kept."""

import corpus_pipeline
from shardlog.session import store


def test_stages_keep_the_columns_and_round_trip(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in docs.collect()} and all(r.round_trip for r in last)
