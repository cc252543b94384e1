import pyspark.sql.functions as F
import pytest

from tillroll.llm import jaccard, minhash
from tillroll.llm.common import narrowed

WORDS = [f"w{i}" for i in range(200)]


def test_narrowed_keeps_all_that_are_asked_for_and_few_others(spark):
    rows = spark.range(20_000).select(F.col("id").alias("node"), F.lit("x").alias("text")).union(spark.createDataFrame([(None, "y")], "node long, text string"))
    keys = spark.range(0, 20_000, 50).select(F.col("id").alias("node"))
    kept = [r.node for r in narrowed(rows, keys, "node").collect()]
    assert set(range(0, 20_000, 50)) <= set(kept) and len(kept) < 500
    assert narrowed(rows, keys.limit(0), "node").columns == rows.columns and narrowed(rows, keys.limit(0), "node").isEmpty()


def below(plan, name):
    """The lines of a plan below the one that names an operator."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if name in line)
    depth = lines[at].index(name)
    rest = []
    for line in lines[at + 1 :]:
        if next((i for i, c in enumerate(line) if c.isalnum()), 0) < depth:
            break
        rest.append(line)
    return rest


@pytest.fixture
def no_small_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_that_meet_nothing_are_not_exchanged(spark, tmp_path, monkeypatch, no_small_tables):
    """On tables that are too large to be broadcast, whole texts were exchanged to tell which are wanted."""
    texts = [" ".join(WORDS), " ".join(WORDS[1:]), *[" ".join(f"{i}{w}" for w in WORDS) for i in range(20)]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    plans = []
    compared, stored = minhash.compared, jaccard.stored
    monkeypatch.setattr(minhash, "compared", lambda cells: plans.append(("MapInArrow", cells)) or compared(cells))
    assert {r.component_id for r in minhash.near_duplicates(docs).collect()} == {0, *range(2, 22)}
    monkeypatch.setattr(jaccard, "stored", lambda df, name: (plans.append(("SortMergeJoin", df)) if name == "open-sets" else None) or stored(df, name))
    assert {r.component_id for r in jaccard.jaccard_join(docs).collect()} == {0, *range(2, 22)}
    assert len(plans) == 2
    for operator, df in plans:
        under = below(df._jdf.queryExecution().executedPlan().toString(), operator)
        scan = next(i for i, line in enumerate(under) if "FileScan parquet" in line and "text#" in line)
        assert any("BroadcastHashJoin" in line for line in under[:scan]), operator


def test_one_set_of_a_document_with_several(spark):
    rows = [(1, "b", 3), (1, "a", 4), (2, "c", 5), (None, "d", 6)]
    classes = spark.createDataFrame(rows, "node long, set_digest string, entries long")
    got = minhash.one_set_each(classes.filter("node IS NOT NULL")).collect()
    assert sorted((r.node, r.set_digest, r.entries) for r in got) == [(1, "a", 4), (2, "c", 5)]
