"""The pipeline: what each stage keeps, and how it bears odd and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from pagewell.llm.shared import materialise

FOLDER = "/root/testdata/sf0.001"


def stages(spark, docs):
    out = []
    for name, stage in pipeline.STAGES:
        docs = materialise(stage(spark, docs, FOLDER), name)
        out.append(docs)
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good, known, distinct, mixed, packed = stages(spark, docs)
    for kept in (good, known, distinct, mixed):
        assert kept.columns == docs.columns and kept.exceptAll(docs.limit(0)).count() > 0
        assert kept.distinct().exceptAll(docs).count() == 0
    long = docs.where(F.size(F.split("text", r"\s+")) >= 60)
    clean = long.join(labels.where("quality = 1"), "doc_id", "left_semi")
    assert clean.join(good, "doc_id", "left_anti").count() <= 0.02 * clean.count()
    assert good.join(labels.where("quality = 0"), "doc_id", "left_semi").count() == 0
    assert known.count() == good.count()  # all texts there are in a known language
    assert 0 < distinct.count() <= known.select("text").distinct().count()
    assert packed.agg(F.countDistinct("doc_id")).first()[0] == mixed.select("doc_id").distinct().count()


@pytest.mark.parametrize("empty", [False, True])
def test_odd_tables(spark, odd_docs, no_docs, empty):
    docs = no_docs if empty else odd_docs
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != "packing":
            assert out.columns == docs.columns
        assert out.count() == 0 if empty else out.count() > 0
