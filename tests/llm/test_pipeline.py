"""The pipeline's stages, one after the other and together."""

from __future__ import annotations

import corpus_pipeline
from eventloom.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == COLUMNS
        assert 0 < docs.count() <= before
        assert docs.where("n_chars <> char_length(text)").count() == 0
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == before
    # Near copies are gone: the join finds no class of two among what is left.
    from eventloom.llm.jaccard_join import set_classes
    from eventloom.llm.pii import pii_report

    assert set_classes(docs).where("component_id <> doc_id").count() <= before * 0.02
    assert pii_report(docs).where("spans <> ''").count() == 0


def test_run_equals_its_stages(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "suffix_array_dedup", "pii", "packing",
    ]
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns[0] == "doc_id" and rows.count() > 100


def test_empty_documents(spark, sf_dir, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), "test-empty")
        assert docs.count() == 0


def test_odd_documents(spark, sf_dir, odd_docs):
    """NULL ids and texts, repeated rows and clashing columns, through all stages."""
    docs, before = odd_docs, odd_docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"test-odd-{name}")
        assert docs.columns == odd_docs.columns
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.where("start = 0").count() == before
