"""Hypothesis tests from sufficient statistics.

Each test is one aggregation to a handful of rows; the statistic and its
p-value are expressions on that result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.pvalues import f_upper, t_two_sided

ALPHA = 0.05


def _decision(p: Column, alpha: float) -> Column:
    return F.when(p < alpha, "reject").otherwise("fail to reject")


def welch_ttest(df: DataFrame, value: Column, in_first: Column, alpha: float = ALPHA) -> DataFrame:
    """Welch's t-test of the mean of ``value`` between two groups.

    ``in_first`` marks the first group; a null mark counts as second group.
    """
    first = F.coalesce(in_first, F.lit(False))
    one, two = F.when(first, value), F.when(~first, value)
    s = df.agg(
        F.count(one).cast("double").alias("n1"),
        F.count(two).cast("double").alias("n2"),
        F.avg(one).alias("m1"),
        F.avg(two).alias("m2"),
        F.var_samp(one).alias("v1"),
        F.var_samp(two).alias("v2"),
    )
    e1, e2 = F.try_divide(F.col("v1"), F.col("n1")), F.try_divide(F.col("v2"), F.col("n2"))
    s = s.select(
        F.col("n1").cast("bigint").alias("n1"),
        F.col("n2").cast("bigint").alias("n2"),
        F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(e1 + e2)).alias("t"),
        F.try_divide(
            F.pow(e1 + e2, F.lit(2.0)),
            F.try_divide(e1 * e1, F.col("n1") - 1) + F.try_divide(e2 * e2, F.col("n2") - 1),
        ).alias("df"),
    )
    s = s.withColumn("p_value", t_two_sided(F.col("t"), F.col("df")))
    return s.withColumn("decision", _decision(F.col("p_value"), alpha))


def pearson_test(df: DataFrame, x: str, y: str, alpha: float = ALPHA) -> DataFrame:
    """Pearson correlation of two columns with its t statistic and p-value."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    s = both.agg(
        F.count(F.lit(1)).alias("n"),
        F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("r"),
    )
    freedom = (F.col("n") - 2).cast("double")
    s = s.withColumn("t", F.col("r") * F.sqrt(F.try_divide(freedom, 1 - F.col("r") * F.col("r"))))
    s = s.withColumn("p_value", t_two_sided(F.col("t"), (F.col("n") - 2).cast("double")))
    return s.withColumn("decision", _decision(F.col("p_value"), alpha))


def anova(df: DataFrame, value: str, group: Column, alpha: float = ALPHA) -> DataFrame:
    """One-way analysis of variance of ``value`` over the groups present."""
    groups = (
        df.filter(F.col(value).isNotNull())
        .groupBy(group.alias("g"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.avg(value).alias("m"),
            F.var_pop(value).alias("v"),
        )
    )
    # deviations from the grand mean, not squares of means, which would cancel
    off = F.col("m") - groups.agg(F.sum(F.col("n") * F.col("m")) / F.sum("n")).scalar()
    s = groups.agg(
        (F.count(F.lit(1)) - 1).cast("double").alias("df_between"),
        (F.sum("n") - F.count(F.lit(1))).alias("df_within"),
        F.sum(F.col("n") * off * off).alias("ss_between"),
        F.sum(F.col("n") * F.col("v")).alias("ss_within"),
    )
    s = s.withColumn(
        "f",
        F.try_divide(
            F.try_divide(F.col("ss_between"), F.col("df_between")),
            F.try_divide(F.col("ss_within"), F.col("df_within")),
        ),
    )
    s = s.withColumn("p_value", f_upper(F.col("f"), F.col("df_between"), F.col("df_within")))
    return s.withColumn("decision", _decision(F.col("p_value"), alpha))
