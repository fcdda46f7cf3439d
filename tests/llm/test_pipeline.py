"""The pipeline's stages on planted cases, and registered queries against SQL."""

import re

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from catalog_star.llm.queries import QUERIES, SQL
from catalog_star.staging import stage
from tests.llm.conftest import prose
from tools.compare import compare, connect

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, connect(DATA), name, DATA) is None


def test_registered():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    extra = [(10_000 + i, prose(70, 300, 400).upper() if i % 2 else prose(70, 300, 400) + " " * i, "en", "src0", 5) for i in range(5)] + [(20_000, "12345 678 !!", "en", "src1", 5), (20_001, None, None, None, None)]
    docs = stage(docs.unionByName(spark.createDataFrame(extra, docs.schema)), "test-docs")
    for name, function in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(function(spark, docs, DATA), "test-stage")
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert docs.where("text is null").count() == 0
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        if name == "language":
            assert before - len(ids) <= 4 and not {20_000, 20_001} & set(ids)
        if name == "near_duplicates":
            assert [i for i in ids if 10_000 <= i < 20_000] == [10_000] and len(ids) == len(set(ids))
        if name == "mixture":
            assert len(ids) > len(set(ids))
    assert set(docs.columns) >= {"doc_id", "piece", "start", "length", "sequence_id", "offset"}
    assert docs.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 4096").count() == 0


def test_run_equals_the_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, DATA), "test-stage")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    again = corpus_pipeline.run(spark, DATA)
    assert sorted(map(tuple, again.select(columns).collect())) == sorted(map(tuple, docs.select(columns).collect()))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("false")
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, DATA), "test-stage")
        assert docs.count() == 0


def test_mixture_stage_sends_no_slots_through_the_driver(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * (i + 1), "en", f"s{i % 3}", i) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    plan = corpus_pipeline.mix_sources(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"(\w+Join) \[source_rank#\d+, block#\d+L?\]", plan) == ["SortMergeJoin"]
