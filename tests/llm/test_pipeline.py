"""Stages keep the columns of documents, work on what was kept, and end in whole sequences."""

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        assert out.columns == COLUMNS
        after = out.count()
        assert 0 < after and (after <= before or name == "source mix")
        docs, before = out, after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").toPandas()
    assert set(pieces.doc_id) == {r.doc_id for r in docs.select("doc_id").collect()}
    assert pieces.groupby("sequence_id").length.sum().max() <= 1024


def test_an_empty_table_passes_all_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, ""), "stage")
    assert docs.count() == 0
