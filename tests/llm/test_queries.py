"""Registered queries of the text operators against their SQL, and the pipeline as a whole."""

import os

import pytest
from pyspark.sql import functions as F

from sightline.llm.registry import load_all
from tests.oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_all()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    ok, message = compare(QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name])
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_a_row_for_each_document(spark, name):
    ids = [r["doc_id"] for r in QUERIES[name](spark, SMALL).collect()]
    want = [r["doc_id"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()]
    assert sorted(ids) == sorted(want)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    seen = set(docs.columns)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert 0 < docs.count() <= before
        if k + 1 < len(corpus_pipeline.STAGES):
            assert set(docs.columns) == seen and docs.where(F.length("text") != F.col("n_chars")).count() == 0
    assert docs.where("NOT round_trip").count() == 0
    assert docs.join(labels.where("quality = 1"), "doc_id").count() > 0


def test_pipeline_of_messy_and_empty_documents(spark, tmp_path):
    import corpus_pipeline

    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for n, rows in enumerate(([], [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "word " * 3000, None, None, 9)])):
        folder = f"{tmp_path}/{n}"
        spark.createDataFrame(rows, kind).write.parquet(f"{folder}/documents.parquet")
        for name in ("labels", "benchmark"):
            os.symlink(f"{SMALL}/{name}.parquet", f"{folder}/{name}.parquet")
        corpus_pipeline.run(spark, folder).collect()


def test_repeats_stage_gives_one_row_for_each_row(spark):
    import corpus_pipeline

    kind = "doc_id long, text string, lang string, source string, n_chars long"
    long = "some words that are repeated in more than one of the given documents"
    rows = [(1, long, "en", "a", 0)] + [(2, long + " x", "en", "b", 0)] * 3 + [(2, "other", "de", "c", 0)] + [(None, long, None, "d", 0)] * 3 + [(None, None, "fr", None, 0)]
    got = corpus_pipeline.repeats(spark, spark.createDataFrame(rows, kind), SMALL).collect()
    cut = [(1, long, "en", "a")] + [(2, "x", "en", "b")] * 3 + [(2, "other", "de", "c")] + [(None, long, None, "d")] * 3 + [(None, "", "fr", None)]
    assert sorted(((r["doc_id"], r["text"].strip(), r["lang"], r["source"]) for r in got), key=repr) == sorted(cut, key=repr)
