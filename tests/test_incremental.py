"""Quarantine, counters of the cleaning job, sketches, monthly and bucketed sinks."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import cleaning, hypothesis, sketched
from tillroll.schema import LINE_COLUMNS, RAW_TO_NAME
from tillroll.session import durable
from tillroll.sources import partitioned
from tillroll.sources.quarantine import REASONS, good_lines, judge_records, quarantine, reason_counts, scan_csv_judged

HEADER = ",".join(RAW_TO_NAME)
RECORDS = {
    "1,A,mug,2,2023-01-01,1.5,100,UK": None,
    '2,B,"a, ""b""",-3,01/02/2023,2.0,,France': None,
    "3,C,,NaN,2023-01-03 10:00:00,NA,101.0,UK": None,
    "4,D,mug,two,2023-01-01,1.5,100,UK": "quantity",
    "5,E,mug,2,tomorrow,1.5,100,UK": "invoice_date",
    "6,F,mug,2,2023-01-01,dear,100,UK": "unit_price",
    "7,G,mug,2,2023-01-01,1.5,nobody,UK": "customer_id",
    "8,H,mug,2,2023-01-01,1.5,100,UK,more": "malformed",
    "9,I,mug": "malformed",
    "10,J,mug,two,tomorrow,1.5,100,UK": "quantity",
    "11,K,mug,99999999999,2023-01-01,1.5,100,UK": "quantity",
}


def test_records_are_judged(spark):
    judged = judge_records(spark.createDataFrame([(r,) for r in RECORDS], "record string"), "record")
    got = {r.invoice_no: r for r in judged.collect()}
    assert {r.split(",")[0]: reason for r, reason in RECORDS.items()} == {k: r.reason for k, r in got.items()}
    assert got["2"].description == 'a, "b"' and got["2"].customer_id is None and got["3"].quantity is None and got["3"].unit_price is None
    assert got["4"].rejected_text == "two" and got["8"].rejected_text.endswith("more") and got["5"].rejected_text == "tomorrow"
    assert set(REASONS) == {r for r in RECORDS.values() if r}
    assert judge_records(spark.createDataFrame([(None,)], "record string"), "record").count() == 1


def test_files_are_judged_like_records_and_split_in_one_pass(spark, tmp_path):
    for n in range(2):
        (tmp_path / f"{n}.csv").write_text("\n".join([HEADER, *RECORDS]) + "\n", encoding="latin-1")
    judged = scan_csv_judged(spark, str(tmp_path / "*.csv"))
    counts = {r.reason: r.lines for r in reason_counts(judged).collect()}
    assert counts == {"good": 6, "malformed": 4, "quantity": 6, "invoice_date": 2, "unit_price": 2, "customer_id": 2}
    good, rejected = quarantine(judged, str(tmp_path / "out"))
    assert good.columns == LINE_COLUMNS and good.count() == 6 and rejected.count() == 16
    assert sorted(map(str, good.collect())) == sorted(map(str, good_lines(judged).collect()))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "rejected" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(Exception):
        from tillroll.sources.lines import scan_csv

        scan_csv(spark, str(tmp_path / "*.csv")).collect()


def test_audit_is_counted_by_the_cleaning_job(spark, tables, tmp_path):
    tables.raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    plans = []

    def store(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return durable(df, "observed")

    cleaned, audit = cleaning.clean_lines_observed(raw, store)
    assert sorted(map(tuple, audit.collect())) == sorted(map(tuple, cleaning.clean_audit(raw).collect()))
    assert plans[0].count("FileScan parquet") == 1 and plans[0].count("CollectMetrics") == 2
    assert cleaned.exceptAll(cleaning.clean_lines(raw)[0]).isEmpty() and cleaned.count() == cleaning.clean_lines(raw)[0].count()


def test_sketches_merge_over_days(spark, tables):
    lines = tables.purchases.filter("month(invoice_date) < 7"), tables.purchases.filter("month(invoice_date) >= 7")
    parts = [sketched.distinct_sketches(p, ["country"], "invoice_no") for p in lines]
    merged = {r.country: r.estimate for r in sketched.merged_distinct(parts[0].unionByName(parts[1]), ["country"]).collect()}
    exact = {r.country: r.n for r in tables.purchases.groupBy("country").agg(F.count_distinct("invoice_no").alias("n")).collect()}
    assert set(merged) == set(exact)
    assert all(abs(merged[c] - exact[c]) <= max(1, sketched.distinct_bound() * exact[c]) for c in exact)
    columns = ["unit_price", "quantity"]
    halves = [sketched.quantile_sketches(p, columns) for p in lines]
    found = sketched.merged_quantiles(halves[0].unionByName(halves[1]), columns, [0.1, 0.5, 0.99]).collect()
    assert len(found) == 6
    for r in found:
        values = np.sort([v[0] for v in tables.purchases.select(F.col(r.column).cast("double")).collect()])
        low, high = (np.searchsorted(values, r.value, side) / len(values) for side in ("left", "right"))
        assert low - sketched.rank_bound() <= r.q <= high + sketched.rank_bound()


def test_sketches_of_nothing(spark, tables):
    nothing = tables.purchases.filter("false")
    assert sketched.merged_distinct(sketched.distinct_sketches(nothing, ["country"], "invoice_no"), ["country"]).count() == 0
    sketches = sketched.quantile_sketches(nothing, ["quantity"])
    assert sketched.merged_quantiles(sketches, ["quantity"], [0.5]).count() == 0
    assert sketched.cap_upper_sketched(tables.customers, sketches, ["quantity"]).count() == tables.customers.count()


def test_capping_by_sketches(spark):
    rfm = spark.range(10_000).selectExpr("id AS customer_id", "CAST(id AS DOUBLE) AS monetary", "timestamp'2020-01-01' AS invoice_date")
    sketches = sketched.quantile_sketches(rfm, ["monetary"])
    most = sketched.cap_upper_sketched(rfm, sketches, ["monetary"]).agg(F.max("monetary")).first()[0]
    assert abs(most / 10_000 - 0.99) <= sketched.rank_bound()


def test_one_month_is_rebuilt_alone(spark, tables, tmp_path):
    path = str(tmp_path / "months")
    partitioned.write_months(tables.cleaned, path)
    months = sorted(p.name.removeprefix("month=") for p in Path(path).glob("month=*"))
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    partitioned.rebuild_months(tables.cleaned.filter("quantity > 1"), path, [months[3]])
    after = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    same = {p for p in before if after.get(p) == before[p]}
    assert same == {p for p in before if p.parent.name != f"month={months[3]}"}
    changed = partitioned.read_months(spark, path, months[3], months[3])
    expected = partitioned.with_month(tables.cleaned).filter((F.col("month") == months[3]) & (F.col("quantity") > 1))
    assert changed.count() == expected.count() > 0
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    partitioned.rebuild_months(tables.cleaned.filter("false"), path, [months[0]])
    assert partitioned.read_months(spark, path).filter(F.col("month") == months[0]).isEmpty()


def test_bucketed_tables_join_without_exchange(spark, tables):
    lines = partitioned.write_bucketed(tables.purchases.select("customer_id", "invoice_no"), "bucketed_lines")
    customers = partitioned.write_bucketed(tables.customers.select("customer_id", "frequency"), "bucketed_customers")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lines.groupBy("customer_id").agg(F.count("*").alias("n")).join(customers, "customer_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == tables.customers.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_lines")
        spark.sql("DROP TABLE bucketed_customers")


def test_anova_of_large_means_and_many_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(1e9 + g % 3 + rng.normal())) for g in range(500) for _ in range(4)]
    got = hypothesis.anova(spark.createDataFrame(rows, "g int, v double"), "v", F.col("g")).first()
    values = {}
    for g, v in rows:
        values.setdefault(g, []).append(v - 1e9)
    grand = np.mean([v for vs in values.values() for v in vs])
    between = sum(len(v) * (np.mean(v) - grand) ** 2 for v in values.values())
    within = sum(len(v) * np.var(v) for v in values.values())
    assert got.f == pytest.approx(between / 499 / (within / 1500), rel=1e-5)
    assert hypothesis.anova(spark.createDataFrame([], "g int, v double"), "v", F.col("g")).first().f is None
