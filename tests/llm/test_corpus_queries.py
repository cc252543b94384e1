"""Queries against their SQL or brute force on the smallest tables, and the pipeline's stages."""

import pytest
from check_queries import connect, difference

import __spark_entry__ as entry
import corpus_pipeline
from tillroll.llm.common import table
from tillroll.llm.oracles import ORACLES
from tillroll.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, name):
    rows, problem = difference(spark, connect(FOLDER), QUERIES[name], ORACLES.get(name), FOLDER)
    assert problem is None and rows > 0


def test_operators_are_registered():
    named = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= named and set(ORACLES) <= set(entry.oracle_sql())
    assert {int(name.split("_")[0].removeprefix("op")) for name in QUERIES} == set(range(1, 14))


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents").cache()
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns
        now = docs.count()
        assert now == before if name == "secret scans" else 0 < now <= before
        before = now
    assert docs.select("doc_id").distinct().count() == before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == before


def test_shared_passages_and_copies_go(spark):
    kept = table(spark, FOLDER, "documents")
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, FOLDER)
    assert kept.groupBy("text").count().filter("count > 1").isEmpty()
