"""Numbers where easy formulas fail: small dropout parameters, large means, searches that don't end."""

from math import lgamma

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.functions.minimize import newton_batched
from tillroll.functions.special import scaled_hypergeometric
from tillroll.operators import clv, hypothesis, segments


def by_quadrature(m: clv.PurchaseModel, horizon: float, x: float, tx: float, t: float) -> float:
    """Expectation over the dropout probability p = 1 / (1 + exp(-s)) of an active customer, by the trapezoid rule."""
    s = np.arange(-4000, 4001) * 0.05
    p, rest = 1 / (1 + np.exp(-s)), 1 / (1 + np.exp(s))
    bought = -np.expm1(-(m.r + x) * np.log1p(p * horizon / (m.alpha + t))) / p
    norm = np.exp(lgamma(m.a) + lgamma(m.b + x) - lgamma(m.a + m.b + x))
    mean = 0.05 * np.sum(p**m.a * rest ** (m.b + x) * bought) / norm
    gone = m.a / (m.b + x - 1) * ((m.alpha + t) / (m.alpha + tx)) ** (m.r + x) if x else 0.0
    return mean / (1 + gone)


@pytest.mark.parametrize("a, b", [(0.6, 2.5), (0.3, 0.5), (0.1, 0.2), (0.4, 0.6), (1.7, 0.4)])
@pytest.mark.parametrize("x", [0.0, 1.0, 5.0])
@pytest.mark.parametrize("horizon", [0.1, 5.0, 100.0, 1.2e6])
def test_expected_purchases_match_quadrature(a, b, x, horizon):
    m = clv.PurchaseModel(1.4, 10.8, a, b)
    tx = 0.4 * x
    got = clv._expected(m, horizon, *[np.array([v]) for v in (x, tx, 2.5)])[0]
    assert got == pytest.approx(by_quadrature(m, horizon, x, tx, 2.5), rel=1e-6)


def test_series_says_when_it_does_not_settle():
    assert scaled_hypergeometric(1.4, 0.5, 1.2, 0.99)[0] > 0
    with pytest.raises(ArithmeticError):
        scaled_hypergeometric(1.4, 0.5, 1.2, 0.99999, terms=1000)


def test_search_says_when_it_does_not_end():
    def rosenbrock(p):
        return (1 - p[:, 0]) ** 2 + 100 * (p[:, 1] - p[:, 0] ** 2) ** 2

    assert newton_batched(rosenbrock, np.array([-1.2, 1.0]), steps=200) == pytest.approx([1, 1], abs=1e-2)
    with pytest.raises(ArithmeticError):
        newton_batched(rosenbrock, np.array([-1.2, 1.0]), steps=5)


def test_fits_end_where_the_gradient_is_flat(spark):
    rng = np.random.default_rng(3)
    x = rng.poisson(2, 500)
    rows = [(int(n), float(n) * 2, 20.0, float(rng.gamma(2) + 1)) for n in x]
    summary = spark.createDataFrame(rows, "x bigint, tx double, t double, monetary_value double")
    v = clv.fit_value_model(summary, penalizer=0.0)
    repeat = [r for r in rows if r[0]]

    def mean(logs):
        return clv.value_log_likelihood(np.exp(logs), *[np.array([r[i] for r in repeat], float) for i in (0, 3)]).mean()

    at = np.log([v.p, v.q, v.v])
    slopes = [(mean(at + e) - mean(at - e)) / 2e-4 for e in np.eye(3) * 1e-4]
    assert np.abs(slopes).max() < 1e-3


def test_value_model_rejects_bad_means(spark):
    summary = spark.createDataFrame([(2, 1.0, 3.0, 10.0), (1, 1.0, 3.0, 0.0)], "x bigint, tx double, t double, monetary_value double")
    with pytest.raises(ValueError):
        clv.fit_value_model(summary)


@pytest.mark.parametrize("mean", [0.0, 1e6, 1e9])
def test_tests_of_means_stand_large_means(spark, mean):
    rng = np.random.default_rng(11)
    noise, group = rng.normal(size=20_000), rng.integers(0, 5, 20_000)
    noise = np.round(noise * 1024) / 1024  # so that adding a large mean loses nothing
    df = spark.createDataFrame([(int(g), float(v + mean), float(v + mean)) for g, v in zip(group, noise)], "g int, v double, w double")
    means = [noise[group == g] for g in range(5)]
    between = sum(len(s) * (s.mean() - noise.mean()) ** 2 for s in means)
    got = hypothesis.anova(df, "v", F.col("g")).first()
    rel = 1e-9 if mean == 0 else 1e-6 if mean == 1e6 else 1e-2
    assert got.ss_between == pytest.approx(between, rel=rel)
    one, two = noise[group == 0], noise[group != 0]
    t = (one.mean() - two.mean()) / np.sqrt(one.var(ddof=1) / len(one) + two.var(ddof=1) / len(two))
    assert hypothesis.welch_ttest(df, F.col("v"), F.col("g") == 0).first().t == pytest.approx(t, rel=rel)
    assert hypothesis.pearson_test(df, "v", "w").first().r == pytest.approx(1.0, rel=1e-6)


def test_labels_need_four_profiles(spark):
    three = spark.createDataFrame([(0, 1.0, 5.0), (1, 2.0, 4.0), (2, 3.0, 3.0)], "cluster int, monetary double, recency double")
    with pytest.raises(Exception, match="four profiles"):
        segments.label_clusters(three).collect()


def test_silhouette_is_one_formula_at_every_size(spark):
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(0, 1e-3, (3000, 3)) + 1e3, rng.normal(0, 1e-3, (3000, 3)) + 1e3 + 0.01])
    rows = [(i, int(i >= 3000), *map(float, p)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "customer_id long, cluster int, " + ", ".join(f"{c} double" for c in segments.SCALED))
    whole = segments.silhouette_sample(df, n=6000).first().silhouette
    part = segments.silhouette_sample(df, n=500).first().silhouette
    assert whole == pytest.approx(part, abs=0.02) and whole > 0.8
