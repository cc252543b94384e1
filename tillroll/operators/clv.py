"""Customer lifetime value: BG/NBD purchase counts and Gamma-Gamma order values.

Formulas: Fader, Hardie and Lee (2005), "Counting Your Customers the Easy Way",
and Fader and Hardie (2013), "The Gamma-Gamma Model of Monetary Value".
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.minimize import newton
from tillroll.functions.special import digamma, log_gamma, scaled_hypergeometric, trigamma
from tillroll.session import durable

DAYS_PER_UNIT = 30.0


@dataclass(frozen=True)
class PurchaseModel:
    """Parameters of the BG/NBD model, in the time unit of the data it was fitted on."""

    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class ValueModel:
    """Parameters of the Gamma-Gamma model."""

    p: float
    q: float
    v: float


def repeat_summary(purchases: DataFrame, unit_days: float = DAYS_PER_UNIT) -> DataFrame:
    """Repeat-purchase history per customer.

    ``x``: purchase days after the first; ``tx``: time of the last one and ``t``:
    time observed, both since the first, in units of ``unit_days``;
    ``monetary_value``: mean total of the repeat days, 0 without any.  Days are
    totalled before customers are, so a very large customer is reduced in many
    tasks.
    """
    end = purchases.agg(F.to_date(F.max("invoice_date"))).scalar()
    days = purchases.groupBy("customer_id", F.to_date("invoice_date").alias("day")).agg(
        F.sum("total_amount").alias("day_total")
    )
    per_customer = days.groupBy("customer_id").agg(
        (F.count(F.lit(1)) - 1).alias("x"),
        F.min("day").alias("first"),
        F.max("day").alias("last"),
        F.sum("day_total").alias("total"),
        F.min_by("day_total", "day").alias("first_total"),
    )
    value = F.when(F.col("x") > 0, (F.col("total") - F.col("first_total")) / F.col("x")).otherwise(0.0)
    return per_customer.select(
        "customer_id",
        "x",
        (F.date_diff("last", "first") / F.lit(unit_days)).alias("tx"),
        (F.date_diff(end, "first") / F.lit(unit_days)).alias("t"),
        value.alias("monetary_value"),
    )


def purchase_log_likelihood(params: np.ndarray, x: np.ndarray, tx: np.ndarray, t: np.ndarray) -> np.ndarray:
    """BG/NBD log-likelihood of each history; ``params`` is (r, alpha, a, b)."""
    r, alpha, a, b = params
    rate = log_gamma(r + x) - log_gamma(r) + r * np.log(alpha)
    drop = log_gamma(a + b) + log_gamma(b + x) - log_gamma(b) - log_gamma(a + b + x)
    alive = -(r + x) * np.log(alpha + t)
    with np.errstate(divide="ignore"):
        gone = np.where(
            x > 0, np.log(a) - np.log(b + np.maximum(x, 1) - 1) - (r + x) * np.log(alpha + tx), -np.inf
        )
    return rate + drop + np.logaddexp(alive, gone)


def value_log_likelihood(params: np.ndarray, x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Gamma-Gamma log-likelihood of each mean order value; ``params`` is (p, q, v)."""
    p, q, v = params
    return (
        log_gamma(p * x + q) - log_gamma(p * x) - log_gamma(q) + q * np.log(v)
        + (p * x - 1) * np.log(m) + p * x * np.log(x) - (p * x + q) * np.log(x * m + v)
    )


def purchase_derivatives(params: np.ndarray, x: np.ndarray, tx: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``purchase_log_likelihood`` with its gradient (4, n) and Hessian (4, 4, n)."""
    r, alpha, a, b = params
    value = purchase_log_likelihood(params, x, tx, t)
    first, second = np.zeros((4, len(x))), np.zeros((4, 4, len(x)))
    # customers who stay and who have left: two terms in a logarithm, weighed by their shares
    late = b + np.maximum(x, 1) - 1
    with np.errstate(divide="ignore"):
        left = np.where(x > 0, np.log(a) - np.log(late) - (r + x) * np.log(alpha + tx), -np.inf)
    share = np.exp(left - np.logaddexp(-(r + x) * np.log(alpha + t), left))
    zero = np.zeros(len(x))
    stay_1 = np.array([-np.log(alpha + t), -(r + x) / (alpha + t), zero, zero])
    left_1 = np.array([-np.log(alpha + tx), -(r + x) / (alpha + tx), zero + 1 / a, -1 / late])
    apart = left_1 - stay_1
    first += (1 - share) * stay_1 + share * left_1
    second += share * (1 - share) * apart[:, None] * apart[None, :]
    second[0, 1] += -(1 - share) / (alpha + t) - share / (alpha + tx)
    second[1, 1] += (r + x) * ((1 - share) / (alpha + t) ** 2 + share / (alpha + tx) ** 2)
    second[2, 2] -= share / a**2
    second[3, 3] += share / late**2
    # the gamma functions
    first[0] += digamma(r + x) - digamma(r) + np.log(alpha)
    first[1] += r / alpha
    both, all_ = digamma(a + b), digamma(a + b + x)
    first[2] += both - all_
    first[3] += both - all_ + digamma(b + x) - digamma(b)
    both, all_ = trigamma(a + b), trigamma(a + b + x)
    second[0, 0] += trigamma(r + x) - trigamma(r)
    second[0, 1] += 1 / alpha
    second[1, 1] -= r / alpha**2
    second[2, 2] += both - all_
    second[2, 3] += both - all_
    second[3, 3] += both - all_ + trigamma(b + x) - trigamma(b)
    second[1, 0], second[3, 2] = second[0, 1], second[2, 3]
    return value, first, second


def value_derivatives(params: np.ndarray, x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``value_log_likelihood`` with its gradient (3, n) and Hessian (3, 3, n)."""
    p, q, v = params
    value = value_log_likelihood(params, x, m)
    total, whole = p * x + q, x * m + v
    both, own = digamma(total), digamma(p * x)
    first = np.array([x * (both - own + np.log(m) + np.log(x) - np.log(whole)), both - digamma(q) + np.log(v) - np.log(whole), q / v - total / whole])
    both, own = trigamma(total), trigamma(p * x)
    second = np.empty((3, 3, len(x)))
    second[0, 0] = x * x * (both - own)
    second[0, 1] = second[1, 0] = x * both
    second[0, 2] = second[2, 0] = -x / whole
    second[1, 1] = both - trigamma(q)
    second[1, 2] = second[2, 1] = 1 / v - 1 / whole
    second[2, 2] = total / whole**2 - q / v**2
    return value, first, second


def _task_sums(histories: DataFrame, columns: list[str], parts: Callable[..., np.ndarray], points: np.ndarray, slots: int) -> DataFrame:
    """``(point, slot, total)``: weighted sums of ``parts`` (slots, n) at each point, and the weight in a last slot.

    One pass for all points: a task returns one row per point and slot.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(points), slots + 1))
        for batch in batches:
            n = batch["n"].to_numpy(dtype=float)
            data = [batch[c].to_numpy(dtype=float) for c in columns]
            total[:, slots] += n.sum()
            total[:, :slots] += [parts(p, *data) @ n for p in points]
        point, slot = np.divmod(np.arange(total.size), slots + 1)
        yield pd.DataFrame({"point": point, "slot": slot, "total": total.reshape(-1)})

    found = histories.select("n", *columns).mapInPandas(sums, "point int, slot int, total double")
    return found.groupBy("point", "slot").agg(F.sum("total").alias("total"))


def log_likelihood_sums(
    histories: DataFrame, columns: list[str], density: Callable[..., np.ndarray], points: np.ndarray
) -> DataFrame:
    """Weighted log-likelihood of ``histories`` at each parameter point: ``(point, log_likelihood, weight)``.

    ``histories`` has a weight column ``n``.
    """
    sums = _task_sums(histories, columns, lambda *a: density(*a)[None, :], points, 1)
    return sums.groupBy("point").agg(*[F.sum(F.when(F.col("slot") == i, F.col("total"))).alias(c) for i, c in enumerate(("log_likelihood", "weight"))])


def mean_derivatives(histories: DataFrame, columns: list[str], derivatives, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean log-likelihood (k), gradient (k, d) and Hessian (k, d, d) at k points, in one job."""
    d = points.shape[1]
    upper = np.triu_indices(d)

    def parts(*args) -> np.ndarray:
        value, first, second = derivatives(*args)
        return np.concatenate([value[None, :], first, second[upper]])

    slots = 1 + d + len(upper[0])
    totals = np.full((len(points), slots + 1), np.nan)
    for row in _task_sums(histories, columns, parts, points, slots).collect():  # one row per point and slot
        totals[row["point"], row["slot"]] = row["total"]
    totals = totals[:, :slots] / totals[:, slots:]
    hessian = np.empty((len(points), d, d))
    hessian[:, upper[0], upper[1]] = hessian[:, upper[1], upper[0]] = totals[:, 1 + d :]
    return totals[:, 0], totals[:, 1 : 1 + d], hessian


#: Rows of a task that evaluates a likelihood.
FIT_ROWS = 50_000


def _fit(histories: DataFrame, columns: list[str], derivatives, d: int, penalizer: float) -> np.ndarray:
    """Maximise the penalised mean log-likelihood over positive parameters, in their logarithms."""
    stored = durable(histories, "histories")
    kept = stored.coalesce(max(1, -(-stored.count() // FIT_ROWS))).persist(StorageLevel.MEMORY_AND_DISK)

    def derivatives_at(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        points = np.exp(logs)
        value, first, second = mean_derivatives(kept, columns, derivatives, points)
        value = penalizer * (points**2).sum(1) - value
        first = points * (2 * penalizer * points - first)
        second = points[:, :, None] * points[:, None, :] * (2 * penalizer * np.eye(d) - second)
        second[:, np.arange(d), np.arange(d)] += first
        return value, first, second

    try:
        return np.exp(newton(derivatives_at, np.full(d, 0.1)))
    finally:
        kept.unpersist()


def fit_purchase_model(
    summary: DataFrame, penalizer: float = 0.05, time_scale: float | None = None
) -> PurchaseModel:
    """Fit BG/NBD to ``repeat_summary``.

    Equal histories are counted once.  Times are multiplied by ``time_scale``
    (10 / longest observation time by default) while fitting, which is where
    the penalty on the squared parameters applies, and alpha is scaled back.
    """
    histories = summary.groupBy("x", "tx", "t").agg(F.count(F.lit(1)).alias("n"))
    if time_scale is None:
        longest = summary.agg(F.max("t")).first()[0] or 1.0
        time_scale = 10.0 / longest
    scaled = histories.withColumns({"tx": F.col("tx") * time_scale, "t": F.col("t") * time_scale})
    r, alpha, a, b = _fit(scaled, ["x", "tx", "t"], purchase_derivatives, 4, penalizer)
    return PurchaseModel(float(r), float(alpha / time_scale), float(a), float(b))


def fit_value_model(summary: DataFrame, penalizer: float = 0.05) -> ValueModel:
    """Fit Gamma-Gamma to the customers with repeat purchases; their mean values must be positive."""
    repeat = summary.filter(F.col("x") > 0)
    bad = repeat.filter(~(F.col("monetary_value") > 0) | F.col("monetary_value").isNull()).count()
    if bad:
        raise ValueError(f"{bad} customers with repeat purchases have no positive mean value")
    histories = (
        repeat.groupBy("x", "monetary_value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    p, q, v = _fit(histories, ["x", "monetary_value"], value_derivatives, 3, penalizer)
    return ValueModel(float(p), float(q), float(v))


def _expected(model: PurchaseModel, horizon: float, x, tx, t) -> np.ndarray:
    a = model.a + 1e-9 if model.a == 1.0 else model.a
    r, alpha, b = model.r, model.alpha, model.b
    before, after = alpha + t, alpha + t + horizon
    c, z, stay = a + b + x - 1, horizon / after, before / after
    # near z = 1 the series is slow; Euler's form of the same function is not
    near = z > 0.9
    series = np.empty(np.shape(x))
    series[~near] = stay[~near] ** (r + x[~near]) * scaled_hypergeometric(r + x[~near], b + x[~near], c[~near], z[~near])
    series[near] = stay[near] ** (a - 1) * scaled_hypergeometric(a + b - 1 - r, a - 1, c[near], z[near])
    top = (c - series) / (a - 1)
    gone = np.where(x > 0, a / (b + np.maximum(x, 1) - 1) * (before / (alpha + tx)) ** (r + x), 0.0)
    return top / (1 + gone)


def purchase_flow(
    model: PurchaseModel, x: Column, tx: Column, t: Column, months: int = 3, discount_rate: float = 0.01
) -> Column:
    """Purchases expected in the next time unit, and the discounted sum of those of ``months`` units, as one struct."""

    @F.pandas_udf("next double, discounted double")
    def run(x: pd.Series, tx: pd.Series, t: pd.Series) -> pd.DataFrame:
        data = [s.to_numpy(dtype=float) for s in (x, tx, t)]
        total, before, first = np.zeros(len(x)), np.zeros(len(x)), _expected(model, 1.0, *data)
        for month in range(1, months + 1):
            upto = first if month == 1 else _expected(model, float(month), *data)
            total += (upto - before) / (1 + discount_rate) ** month
            before = upto
        return pd.DataFrame({"next": first, "discounted": total})

    return run(x, tx, t)


def add_lifetime_value(
    summary: DataFrame,
    model: PurchaseModel,
    value: ValueModel,
    months: int = 3,
    discount_rate: float = 0.01,
) -> DataFrame:
    """``expected_purchases`` (next 30 days) and ``predicted_clv`` per customer."""
    x, m = F.col("x"), F.col("monetary_value")
    mean_value = (x * m + value.v) * value.p / (x * value.p + (value.q - 1))
    worth = F.coalesce(F.nanvl(F.col("flow.discounted") * mean_value, F.lit(0.0)), F.lit(0.0))
    flowing = summary.withColumn("flow", purchase_flow(model, x, F.col("tx"), F.col("t"), months, discount_rate))
    return flowing.withColumns({"expected_purchases": F.col("flow.next"), "predicted_clv": worth}).drop("flow")


def attach_lifetime_value(customers: DataFrame, valued: DataFrame) -> DataFrame:
    """Lifetime columns joined to the customer table, 0 where unknown."""
    columns = ["expected_purchases", "predicted_clv"]
    joined = customers.join(valued.select("customer_id", *columns), "customer_id", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in columns})


def scoring_history(inputs: DataFrame) -> DataFrame:
    """Model inputs for customers known only by recency, frequency and monetary value."""
    repeats = F.greatest(F.col("frequency").cast("double") - 1, F.lit(0.0))
    return inputs.withColumns(
        {
            "x": repeats,
            "tx": repeats,
            "t": repeats + F.col("recency").cast("double") / DAYS_PER_UNIT,
            "monetary_value": F.col("monetary").cast("double")
            / F.greatest(F.col("frequency").cast("double"), F.lit(1.0)),
        }
    )


def score_lifetime_value(inputs: DataFrame, model: PurchaseModel, value: ValueModel) -> DataFrame:
    """Lifetime columns for ``(recency, frequency, monetary)`` rows; no repeats, no value."""
    scored = add_lifetime_value(scoring_history(inputs), model, value)
    return scored.withColumn("predicted_clv", F.when(F.col("x") > 0, F.col("predicted_clv")).otherwise(0.0))
