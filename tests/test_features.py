from datetime import datetime

import numpy as np
import pandas as pd
import pytest

from tillroll.functions.histogram import histograms, kernel_density
from tillroll.functions.quantile import exact_percentiles
from tillroll.functions.sampling import sample_exact
from tillroll.operators import rfm


def purchases(spark, rows):
    return spark.createDataFrame(rows, "invoice_no string, customer_id bigint, invoice_date timestamp, total_amount double")


def test_rfm_with_capping(spark):
    lines = purchases(
        spark,
        [("1", 10, datetime(2023, 1, 1), 100.0), ("2", 10, datetime(2023, 1, 2), 50.0), ("3", 11, datetime(2023, 1, 1), 10.0)],
    )
    before = spark.createDataFrame(
        [("1", 10, 1), ("2", 10, 1), ("C9", 10, -1), ("3", 11, 1)], "invoice_no string, customer_id bigint, quantity int"
    )
    out = {r.customer_id: r for r in rfm.cap_upper(rfm.rfm_with_returns(lines, before)).collect()}
    assert out[10].recency == 0 and out[10].frequency == pytest.approx(1.995)
    assert out[10].monetary == pytest.approx(149.3) and out[10].return_ratio == pytest.approx(1 / 3)
    assert out[11].recency == pytest.approx(0.995) and out[11].frequency == 1
    assert out[11].monetary == 10.0 and out[11].return_ratio == 0


def test_recency_counts_whole_days_not_dates(spark):
    lines = purchases(spark, [("1", 1, datetime(2023, 1, 1, 23), 1.0), ("2", 2, datetime(2023, 1, 2, 1), 1.0)])
    assert {r.customer_id: r.recency for r in rfm.rfm_base(lines).collect()} == {1: 0, 2: 0}


@pytest.mark.parametrize("accuracy", [20, 100, 100_000])
def test_percentiles_are_exact_whatever_the_sketch(spark, accuracy):
    rng = np.random.default_rng(3)
    data = pd.DataFrame(
        {
            "hot": np.where(rng.random(5000) < 0.34, 1.0, rng.lognormal(2, 2, 5000)),
            "few": rng.integers(0, 7, 5000).astype(float),
            "gaps": np.where(rng.random(5000) < 0.2, np.nan, rng.normal(size=5000)),
        }
    )
    data["gaps"] = data["gaps"].astype(object).where(data["gaps"].notna(), None)
    qs = [0.0, 0.25, 0.5, 0.75, 0.995, 1.0]
    df = spark.createDataFrame(data, "hot double, few double, gaps double").repartition(5)
    got = {(r.column, r.q): r.value for r in exact_percentiles(df, {c: qs for c in data}, accuracy).collect()}
    assert len(got) == len(qs) * 3
    for (c, q), value in got.items():
        assert value == pytest.approx(pd.to_numeric(data[c]).quantile(q), rel=1e-12), (c, q)


def test_percentile_of_one_value(spark):
    df = spark.createDataFrame([(7.0,)], "v double")
    assert [r.value for r in exact_percentiles(df, {"v": [0.995]}).collect()] == [7.0]


def test_sample_has_exact_size_and_ignores_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = {r.k for r in sample_exact(df, 100, ["k"]).collect()}
    two = {r.k for r in sample_exact(df.repartition(13), 100, ["k"]).collect()}
    assert one == two and len(one) == 100
    assert sample_exact(df, 5000, ["k"]).count() == 1000


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(1).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
    rows = sorted(histograms(df, {"v": "v"}).collect(), key=lambda r: r.bin)
    counts, edges = np.histogram(x, bins=50)
    assert [r.n for r in rows] == counts.tolist()
    assert [r.bin_start for r in rows] == pytest.approx(edges[:-1].tolist())
    same = spark.createDataFrame([(2.0,)] * 4, "v double")
    assert sum(r.n for r in histograms(same, {"v": "v"}).collect()) == 4


def test_density_matches_direct_sum(spark):
    x = np.concatenate([np.random.default_rng(2).normal(size=300), np.full(150, 0.5)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(4)
    rows = sorted(kernel_density(df, ["v"], points=50).collect(), key=lambda r: r.point)
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 50)
    direct = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert [r.density for r in rows] == pytest.approx(direct.tolist())
