"""Figures that are kept up to date by merging sketches, beside the exact ways.

A day's lines are reduced to one small sketch per group; any span of days is a union of sketches, so new days cost
nothing on the old ones.  Each ``*_checked`` function puts an estimate beside the exact value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the registers of a distinct count; its relative standard error is 1.04 / sqrt(2 ** LG_REGISTERS).
LG_REGISTERS = 12
#: Entries of a quantile sketch; its ranks are off by at most about 2.3 / K ** 0.9 with 99 % certainty.
K = 400


def distinct_bound(lg_registers: int = LG_REGISTERS) -> float:
    """Relative error of a distinct count that is exceeded in one of 15,000 cases: four standard errors."""
    return 4 * 1.04 / (1 << lg_registers) ** 0.5


def rank_bound(k: int = K) -> float:
    """Error of a rank, as a share of the rows, that a merged sketch of ``k`` entries keeps; twice what 99 % of them keep."""
    return 2 * 2.3 / k**0.9


def distinct_sketches(lines: DataFrame, groups: list[str], what: str, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """A sketch of the different values of ``what`` per group and day: ``(*groups, day, sketch)``.

    Null values and null dates aren't counted.
    """
    dated = lines.filter(F.col("invoice_date").isNotNull()).withColumn("day", F.to_date("invoice_date"))
    return dated.groupBy(*groups, "day").agg(F.hll_sketch_agg(what, F.lit(lg_registers)).alias("sketch"))


def merged_distinct(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """Estimated number of different values per group over all days of ``sketches``: ``(*groups, estimate)``."""
    merged = sketches.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*groups, F.hll_sketch_estimate("sketch").alias("estimate"))


def distinct_checked(lines: DataFrame, groups: list[str], what: str, store, lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Exact count beside the estimate from stored daily sketches: ``(*groups, exact, estimate, within_bound)``.

    ``store`` writes a table and reads it back.  An estimate may always be off by one.
    """
    estimate = merged_distinct(store(distinct_sketches(lines, groups, what, lg_registers)), groups)
    exact = lines.filter(F.col("invoice_date").isNotNull()).groupBy(*groups).agg(F.count_distinct(what).alias("exact"))
    off = F.abs(F.col("estimate") - F.col("exact"))
    within = off <= F.greatest(F.lit(1.0), F.col("exact") * distinct_bound(lg_registers))
    return exact.join(estimate, groups).select(*groups, "exact", "estimate", within.alias("within_bound"))


def quantile_sketches(lines: DataFrame, columns: list[str], k: int = K) -> DataFrame:
    """A quantile sketch of every column per day: a row ``(day, column -> sketch...)``.  Null values aren't counted."""
    dated = lines.withColumn("day", F.to_date("invoice_date"))
    return dated.groupBy("day").agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in columns])


def merged_quantiles(sketches: DataFrame, columns: list[str], shares: list[float]) -> DataFrame:
    """Estimated quantiles over all days of ``sketches``: ``(column, q, value)``; without values there is no row."""
    merged = sketches.agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])
    each = merged.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("sketch")) for c in columns])))
    wanted = F.array(*[F.lit(q) for q in shares])
    found = F.arrays_zip(wanted.alias("q"), F.kll_sketch_get_quantile_double("sketch", wanted).alias("value"))
    return each.filter(F.kll_sketch_get_n_double("sketch") > 0).select("column", F.inline(found).alias("q", "value"))


def quantiles_checked(lines: DataFrame, columns: list[str], shares: list[float], store, k: int = K) -> DataFrame:
    """``(column, q, value, below, upto, within_bound)``: the shares of rows below and up to each estimated quantile, counted exactly."""
    found = merged_quantiles(store(quantile_sketches(lines, columns, k)), columns, shares).collect()  # a row per column and share
    counts = lines.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.count_if(F.col(r["column"]) < r["value"]).alias(f"below_{i}") for i, r in enumerate(found)],
        *[F.count_if(F.col(r["column"]) <= r["value"]).alias(f"upto_{i}") for i, r in enumerate(found)],
    ).first()
    bound = rank_bound(k)
    rows = []
    for i, r in enumerate(found):
        below, upto = (counts[f"{s}_{i}"] / counts[f"n_{r['column']}"] for s in ("below", "upto"))
        rows.append((r["column"], r["q"], r["value"], below, upto, below - bound <= r["q"] <= upto + bound))
    schema = "column string, q double, value double, below double, upto double, within_bound boolean"
    return lines.sparkSession.createDataFrame(rows, schema)


def cap_upper_sketched(rfm: DataFrame, sketches: DataFrame, columns: list[str], share: float = 0.99) -> DataFrame:
    """``rfm`` with columns capped at a quantile estimated from sketches, for tables where the exact one costs too much.

    A column without values stays as it is.
    """
    caps: dict[str, Column] = {}
    for r in merged_quantiles(sketches, columns, [share]).collect():  # a row per column
        caps[r["column"]] = F.least(F.col(r["column"]).cast("double"), F.lit(r["value"]))
    return rfm.withColumns({c: cap for c, cap in caps.items()}) if caps else rfm
