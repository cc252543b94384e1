from datetime import datetime
from math import lgamma

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.functions.minimize import newton, newton_batched
from tillroll.functions.pvalues import regularized_beta
from tillroll.functions.special import log_gamma, scaled_hypergeometric
from tillroll.operators import clv, eda, hypothesis, segments


def profile_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "cluster int, recency double, frequency double, monetary double")


def test_labels_follow_value_then_recency(spark):
    rows = profile_rows(spark, (0, 10.0, 5.0, 900.0), (1, 90.0, 1.0, 10.0), (2, 40.0, 1.0, 20.0), (3, 20.0, 3.0, 300.0))
    got = {r.cluster: r.segment for r in segments.label_clusters(rows).collect()}
    assert got == {0: "High-Value", 3: "Regular", 1: "At-Risk", 2: "Occasional"}
    tied = profile_rows(spark, (0, 10.0, 5.0, 900.0), (1, 40.0, 1.0, 10.0), (2, 40.0, 1.0, 20.0), (3, 20.0, 3.0, 300.0))
    got = {r.cluster: r.segment for r in segments.label_clusters(tied).collect()}
    assert got[1] == "Occasional" and got[2] == "At-Risk"
    with pytest.raises(ValueError):
        segments.label_clusters(rows, 3)


def blobs(spark, per=60):
    rng = np.random.default_rng(4)
    means = [(300, 1, 20), (60, 3, 80), (20, 9, 700), (3, 30, 6000)]
    rows = []
    for i, (r, f, m) in enumerate(means):
        for _ in range(per):
            rows.append((len(rows), *(float(v * np.exp(rng.normal(0, 0.05))) for v in (r, f, m)), i))
    return spark.createDataFrame(rows, "customer_id bigint, recency double, frequency double, monetary double, blob int")


def test_kmeans_finds_separated_groups(spark):
    customers = blobs(spark).cache()
    model = segments.fit_segments(customers, n_init=3)
    scored = segments.score_segments(customers, model)
    pairs = {(r.blob, r.segment) for r in scored.select("blob", "segment").distinct().collect()}
    assert pairs == {(0, "At-Risk"), (1, "Occasional"), (2, "Regular"), (3, "High-Value")}
    cost = segments.inertia(segments.scale_rfm(customers), model.centres).first().inertia
    assert cost == pytest.approx(model.inertia, rel=1e-6)
    elbow = {r.k: r.inertia for r in segments.elbow_curve(customers, range(1, 5), n_init=2).collect()}
    assert elbow[1] == pytest.approx(3 * 240) and elbow[1] > elbow[2] > elbow[4]
    assigned = segments.assign_clusters(segments.scale_rfm(customers), model.centres)
    near = segments.silhouette_sample(assigned, 200).first()
    assert near.n == 200 and near.silhouette > 0.8


def test_unknown_cluster_is_regular_and_constant_column_scales_to_zero(spark):
    model = segments.SegmentModel([0.0] * 3, [1.0] * 3, [[0.0] * 3, [9.0] * 3], {1: "High-Value"})
    rows = spark.createDataFrame([(0, 0, 0.0), (8000, 8000, 8000.0)], "recency int, frequency int, monetary double")
    assert [r.segment for r in segments.score_segments(rows, model).collect()] == ["Regular", "High-Value"]
    flat = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 2.0)], "recency int, frequency double, monetary double")
    assert {r.z_frequency for r in segments.scale_rfm(flat).collect()} == {0.0}


def test_repeat_summary_counts_days(spark):
    def at(d, h=9):
        return datetime(2023, 1, d, h)

    rows = [(1, at(1), 5.0), (1, at(1, 17), 6.0)]  # one day
    rows += [(2, at(1), 100.0), (2, at(11), 10.0), (2, at(11, 12), 20.0), (2, at(21), 50.0), (3, at(31, 23), 1.0)]
    lines = spark.createDataFrame(rows, "customer_id bigint, invoice_date timestamp, total_amount double")
    got = {r.customer_id: r for r in clv.repeat_summary(lines, unit_days=1).collect()}
    assert (got[1].x, got[1].tx, got[1].t, got[1].monetary_value) == (0, 0.0, 30.0, 0.0)
    assert (got[2].x, got[2].tx, got[2].t, got[2].monetary_value) == (2, 20.0, 30.0, 40.0)
    assert got[3].t == 0.0


def test_special_functions():
    z = np.array([1e-3, 0.1, 0.5, 1.0, 2.5, 10.0, 123.4, 5000.0])
    assert log_gamma(z) == pytest.approx([lgamma(v) for v in z], abs=1e-12, rel=1e-12)
    assert scaled_hypergeometric(1.0, 1.0, 2.0, 0.5)[0] == pytest.approx(4 * np.log(2))
    assert scaled_hypergeometric(2.0, 3.0, 3.0, np.array([0.0, 0.25, 0.9])) == pytest.approx([3, 3 * 0.75**-2, 3 * 0.1**-2])
    assert regularized_beta(0.3, 2.0, 3.0) == pytest.approx(0.3483)
    assert regularized_beta(1 - 1e-3, 200.0, 0.5) == pytest.approx(1 - regularized_beta(1e-3, 0.5, 200.0))


def test_newton_reaches_the_minimum():
    low = newton_batched(lambda p: ((p - [1.0, -2.0]) ** 2 @ [1.0, 5.0]) + (p[:, 0] * p[:, 1] + 2) ** 2, np.zeros(2))
    assert low == pytest.approx([1.0, -2.0], abs=1e-4)


def simulate(n, r, alpha, a, b, horizon, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        rate, p = rng.gamma(r, 1 / alpha), rng.beta(a, b)
        t, x, last = 0.0, 0, 0.0
        while True:
            t += rng.exponential(1 / rate)
            if t > horizon:
                break
            x, last = x + 1, t
            if rng.random() < p:
                break
        out.append((x, last, horizon, float(rng.gamma(2.0 * max(x, 1), 1) * 10 / max(x, 1))))
    return out


def test_fits_recover_simulated_parameters(spark):
    rows = simulate(6000, 0.8, 3.0, 0.9, 2.5, 30.0)
    summary = spark.createDataFrame(rows, "x bigint, tx double, t double, monetary_value double").repartition(4).cache()
    model = clv.fit_purchase_model(summary, penalizer=0.0)
    assert model.r / model.alpha == pytest.approx(0.8 / 3.0, rel=0.15)
    assert model.a / (model.a + model.b) == pytest.approx(0.9 / 3.4, rel=0.2)
    x, tx, t = (np.array([row[i] for row in rows], dtype=float) for i in range(3))

    def mean_ll(r, alpha, a, b):
        return clv.purchase_log_likelihood(np.array([r, alpha, a, b]), x, tx, t).mean()

    best = mean_ll(model.r, model.alpha, model.a, model.b)
    assert best >= mean_ll(0.8, 3.0, 0.9, 2.5)
    values = clv.fit_value_model(summary, penalizer=0.0)
    assert values.p > 0 and values.q > 0 and values.v > 0
    grown = clv.add_lifetime_value(summary, model, values).agg(F.min("predicted_clv"), F.avg("expected_purchases")).first()
    assert grown[0] >= 0 and 0 < grown[1] < 1


def test_likelihood_matches_direct_formula():
    r, alpha, a, b = 1.4, 3.0, 0.7, 2.0
    for x, tx, t in ((0, 0.0, 5.0), (3, 4.0, 6.0)):
        base = lgamma(r + x) - lgamma(r) + r * np.log(alpha)
        base += lgamma(a + b) + lgamma(b + x) - lgamma(b) - lgamma(a + b + x)
        mix = (alpha + t) ** -(r + x) + (a / (b + x - 1) * (alpha + tx) ** -(r + x) if x else 0)
        got = clv.purchase_log_likelihood(np.array([r, alpha, a, b]), *[np.array([float(v)]) for v in (x, tx, t)])
        assert got[0] == pytest.approx(base + np.log(mix))


def test_expected_purchases_without_history_match_the_mean():
    # with no history, E[X(t)] = (a+b-1)/(a-1) * (1 - (alpha/(alpha+t))^r 2F1(r, b; a+b-1; t/(alpha+t)))
    m = clv.PurchaseModel(0.8, 3.0, 2.2, 2.5)
    rng = np.random.default_rng(1)
    rate, p = rng.gamma(m.r, 1 / m.alpha, 400_000), rng.beta(m.a, m.b, 400_000)
    direct = ((1 - np.exp(-rate * p * 4.0)) / p).mean()
    got = clv._expected(m, 4.0, np.array([0.0]), np.array([0.0]), np.array([0.0]))[0]
    assert got == pytest.approx(direct, rel=0.01)


def test_scoring_inputs(spark):
    rows = spark.createDataFrame([(30, 1, 500.0), (60, 5, 500.0)], "recency int, frequency int, monetary double")
    model, value = clv.PurchaseModel(1.4, 10.8, 0.6, 2.5), clv.ValueModel(1.5, 3.2, 50.0)
    one, five = clv.score_lifetime_value(rows, model, value).collect()
    assert (one.x, one.t, one.predicted_clv) == (0.0, 1.0, 0.0) and one.expected_purchases > 0
    assert (five.x, five.tx, five.t, five.monetary_value) == (4.0, 4.0, 6.0, 100.0) and five.predicted_clv > 0


def test_hypothesis_tests_match_closed_forms(spark):
    rng = np.random.default_rng(7)
    g, v = rng.integers(0, 4, 400), rng.normal(size=400)
    v = v + 0.3 * (g == 1)
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(g, v, rng.normal(size=400) + v)], "g int, v double, w double")
    one, two = v[g == 1], v[g != 1]
    e1, e2 = one.var(ddof=1) / len(one), two.var(ddof=1) / len(two)
    w = hypothesis.welch_ttest(df, F.col("v"), F.col("g") == 1).first()
    assert w.t == pytest.approx((one.mean() - two.mean()) / np.sqrt(e1 + e2))
    assert w.df == pytest.approx((e1 + e2) ** 2 / (e1**2 / (len(one) - 1) + e2**2 / (len(two) - 1)))
    groups = [v[g == k] for k in range(4)]
    between = sum(len(x) * (x.mean() - v.mean()) ** 2 for x in groups)
    within = sum(((x - x.mean()) ** 2).sum() for x in groups)
    a = hypothesis.anova(df, "v", F.col("g")).first()
    assert a.f == pytest.approx((between / 3) / (within / 396))
    assert a.ss_between + a.ss_within == pytest.approx(((v - v.mean()) ** 2).sum())
    commons = spark._jvm.org.apache.commons.math3.distribution
    assert w.p_value == pytest.approx(2 * (1 - commons.TDistribution(w.df).cumulativeProbability(abs(w.t))), rel=1e-6)
    assert a.p_value == pytest.approx(1 - commons.FDistribution(3.0, 396.0).cumulativeProbability(a.f), rel=1e-6)
    p = hypothesis.pearson_test(df, "v", "w").first()
    assert p.r == pytest.approx(np.corrcoef(v, [r.w for r in df.collect()])[0, 1]) and p.decision == "reject"


def test_weekday_report_keeps_its_days(spark):
    rows = [("1", datetime(2023, 1, 7)), ("2", datetime(2023, 1, 8)), ("2", datetime(2023, 1, 8)), ("3", datetime(2023, 1, 9))]
    lines = spark.createDataFrame(rows, "invoice_no string, invoice_date timestamp")
    got = {r.weekday: r.orders for r in eda.orders_by_weekday(lines).collect()}
    assert got["Sunday"] == 1 and got["Monday"] == 1 and got["Friday"] is None and "Saturday" not in got


def test_exact_derivatives(spark):
    rng = np.random.default_rng(0)
    x = np.array([0, 0, 1, 3, 40, 2])
    t = rng.uniform(5, 20, 6)
    tx = np.where(x > 0, t * rng.uniform(0.1, 1, 6), 0.0)
    cases = [
        (clv.purchase_derivatives, np.array([0.7, 3.0, 0.4, 1.9]), (x.astype(float), tx, t)),
        (clv.value_derivatives, np.array([1.5, 3.2, 50.0]), (np.array([1.0, 2, 7, 30]), np.array([3.0, 80, 12, 40]))),
    ]
    for derivatives, point, data in cases:
        _, first, second = derivatives(point, *data)
        for i in range(len(point)):
            step = np.zeros(len(point))
            step[i] = 1e-5
            (up, up_1, _), (down, down_1, _) = (derivatives(point + s * step, *data) for s in (1, -1))
            assert first[i] == pytest.approx((up - down) / 2e-5, rel=1e-5, abs=1e-6)
            assert np.allclose(second[i], (up_1 - down_1) / 2e-5, rtol=1e-5, atol=1e-6)


def test_newton_with_derivatives_and_its_failures():
    def bowl(points):
        x, y = points.T
        value = (x - 1) ** 2 + 5 * (y + 2) ** 2
        return value, np.array([2 * (x - 1), 10 * (y + 2)]).T, np.repeat(np.diag([2.0, 10.0])[None], len(points), 0)

    assert newton(bowl, np.zeros(2)) == pytest.approx([1, -2])

    def slope(points):
        return points[:, 0], np.ones_like(points), np.zeros((len(points), 1, 1))

    with pytest.raises(ArithmeticError):
        newton(slope, np.zeros(1), steps=5)


def scaled_rows(spark, points):
    return spark.createDataFrame([tuple(map(float, p)) for p in points], "z_recency double, z_frequency double, z_monetary double")


@pytest.mark.parametrize("shape", ["blobs", "line", "repeated"])
def test_starts_fitted_together_are_no_worse_than_single_fits(spark, shape):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    rng = np.random.default_rng(7)
    points = {
        "blobs": np.vstack([rng.normal(c, 0.4, (80, 3)) for c in ([0, 0, 0], [3, 0, 1], [0, 4, 0], [2, 2, 5])]),
        "line": np.linspace(0, 1, 300)[:, None] * np.ones(3) + rng.normal(0, 0.01, (300, 3)),
        "repeated": np.repeat(rng.integers(0, 4, (12, 3)), 25, 0),
    }[shape]
    df = scaled_rows(spark, points)
    vectors = VectorAssembler(inputCols=df.columns, outputCol="features").transform(df).cache()
    theirs = min(KMeans(k=4, seed=s, maxIter=300, tol=1e-4).fit(vectors).summary.trainingCost for s in range(5))
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("starts", "starts")
    fits = segments.fit_starts(df, [segments.Start(k, s) for k in (4, 2) for s in range(5)])
    jobs = len(status.getJobIdsForGroup("starts"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    ours = min(cost for cost, _ in fits[:5])
    assert ours <= theirs * (1 + 1e-6) + 1e-9 and jobs < 10 * 30
    for cost, centres in fits:
        d = ((points[:, None] - centres[None]) ** 2).sum(2).min(1).sum()
        assert cost == pytest.approx(d, rel=1e-9, abs=1e-9)
    again = segments.fit_starts(df.repartition(5), [segments.Start(4, 0)])
    assert again[0][0] == pytest.approx(fits[0][0], rel=1e-6)


def test_no_points_and_few_points(spark):
    with pytest.raises(ValueError):
        segments.fit_starts(scaled_rows(spark, []), [segments.Start(2, 1)])
    (cost, centres), = segments.fit_starts(scaled_rows(spark, [[0, 0, 0], [1, 1, 1], [1, 1, 1]]), [segments.Start(4, 1)])
    assert cost == 0 and len(centres) == 2


def test_starts_end_after_any_number_of_rounds(spark, monkeypatch):
    """Many clusters along a line need hundreds of rounds; those are counted here without a job each."""
    x = np.linspace(0, 1e6, 40_000)
    rounds = []

    def assigned(kept, centres):
        rounds.append(len(centres))
        out = {}
        for run, own in centres.items():
            order = np.argsort(own[:, 0], kind="stable")
            at = own[order, 0]
            nearest = order[np.searchsorted((at[1:] + at[:-1]) / 2, x)]
            weights = [np.ones(len(x)), x, x, x, 3 * (x - own[nearest, 0]) ** 2]
            out[run] = np.array([np.bincount(nearest, w, len(own)) for w in weights]).T
        return out

    monkeypatch.setattr(segments, "_assigned", assigned)
    line = spark.range(len(x)).selectExpr(*[f"id * {1e6 / (len(x) - 1)!r}D AS {c}" for c in segments.SCALED])
    (cost, centres), = segments.fit_starts(line, [segments.Start(30, 1)])
    assert len(rounds) > 310
    sums = assigned(None, {0: centres})[0]
    assert np.abs(sums[:, 1] / sums[:, 0] - centres[:, 0]).max() <= 1e-4
    with pytest.raises(ArithmeticError):
        segments.fit_starts(line, [segments.Start(30, 1)], steps=20)
