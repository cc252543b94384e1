"""Tail probabilities of t and F statistics."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 1_000_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        change = 1.0
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            change = c * d
            value *= change
        if abs(change - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"the incomplete beta function has not converged at a={a}, b={b}, x={x}")


def regularized_beta(x: float, a: float, b: float) -> float:
    """The regularised incomplete beta function I_x(a, b)."""
    if not (x == x and a == a and b == b):
        return math.nan
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


@F.pandas_udf(T.DoubleType())
def _beta_udf(x: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([regularized_beta(*row) for row in zip(x, a, b)], dtype="float64")


def t_two_sided(t: Column, df: Column) -> Column:
    """Two-sided p-value of a t statistic; meant for one row per test."""
    return _beta_udf(df / (df + t * t), df / 2, F.lit(0.5))


def f_upper(f: Column, d1: Column, d2: Column) -> Column:
    """Upper tail of an F statistic; meant for one row per test."""
    return _beta_udf(d2 / (d2 + d1 * f), d2 / 2, d1 / 2)
