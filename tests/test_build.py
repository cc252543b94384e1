from pathlib import Path

import pytest

from tillroll.operators import cleaning
from tillroll.plans.build import build, recommend, recommend_by_rules
from tillroll.session import durable, shared_dir, stored_tables
from tillroll.sources.artifacts import load_artifacts


def test_build_writes_everything_and_loads_again(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    assert load_artifacts(spark, out).segments is None
    built = build(tables.raw, out)
    again = load_artifacts(spark, out)
    assert all(t is not None for t in again.tables.values())
    assert again.segments.segments == built.segments.segments
    assert again.segments.centres == built.segments.centres
    assert again.purchases == built.purchases and again.values == built.values
    customers = again.tables["rfm_clustered"]
    assert customers.count() == 150 and set(again.segments.segments.values()) == {
        "High-Value", "Regular", "Occasional", "At-Risk",
    }
    assert customers.filter("segment IS NULL OR predicted_clv IS NULL OR predicted_clv < 0").count() == 0
    assert again.tables["rfm_data"].columns == ["recency", "frequency", "monetary"]
    assert again.tables["cleaned_dataset"].count() == 4530
    assert again.tables["product_list"].count() == 187
    known = again.tables["recommendations"].first().description
    asked = spark.createDataFrame([(known,), ("no such thing",)], "description string")
    rows = recommend(again, asked).collect()
    assert len([r for r in rows if r.is_fallback]) == 5 and any(r.description == known for r in rows)
    known = again.tables["association_rules"].first().description
    asked = spark.createDataFrame([(known,), ("no such thing",)], "description string")
    ruled = recommend_by_rules(again, asked).collect()
    stored = again.tables["association_rules"].filter(again.tables["association_rules"]["description"] == known).collect()
    assert sorted((r.rank, r.item, r.lift) for r in ruled if not r.is_fallback) == sorted((r.rank, r.item, r.lift) for r in stored)
    assert [(r.lift, r.confidence) for r in ruled if r.is_fallback] == [(1.0, 1.0)] * 5


def test_missing_model_is_fitted_again(spark, tables, tmp_path):
    out = str(tmp_path / "part")
    tables.customers.withColumn("segment", tables.customers["customer_id"].cast("string")).write.parquet(f"{out}/rfm_clustered")
    found = load_artifacts(spark, out)
    assert found.segments is not None and found.tables["recommendations"] is None and found.purchases is None
    assert found.segments.inertia > 0


def stored_now(spark):
    folder = Path(shared_dir(spark).removeprefix("file://"), "tillroll", spark.sparkContext.applicationId)
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_stored_tables_end_with_their_owner(spark, tables, tmp_path):
    tables.raw.count()
    before = stored_now(spark)
    build(tables.raw, str(tmp_path / "out"))
    assert stored_now(spark) == before
    with pytest.raises(ZeroDivisionError), stored_tables(spark):
        durable(spark.range(3), "numbers")
        assert len(stored_now(spark)) == len(before) + 1
        1 / 0
    assert stored_now(spark) == before
    kept = durable(spark.range(3), "numbers")
    assert kept.count() == 3 and len(stored_now(spark)) == len(before) + 1


def test_history_is_deduplicated_once(tables):
    cleaned = cleaning.clean_lines(tables.raw, before=tables.deduplicated)[0]
    for table in (cleaned, tables.before):
        text = table._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "pre_cancellation" in table.inputFiles()[0]
