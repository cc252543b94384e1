"""Equal-width histograms and kernel density estimates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.onerow import with_one_row


def histograms(df: DataFrame, values: dict[str, str], bins: int = 50) -> DataFrame:
    """Counts in ``bins`` equal bins between minimum and maximum, per series.

    ``values`` maps a series name to a SQL expression; a null leaves the row out.
    One pass finds all ranges, one counts; the highest value falls in the last
    bin.  Empty bins are reported with 0.
    """
    named = list(enumerate(values.items()))
    stats = df.agg(
        *[
            F.expr(f"named_struct('lo', min(CAST({x} AS DOUBLE)), 'hi', max(CAST({x} AS DOUBLE))) AS r{i}")
            for i, (_, x) in named
        ]
    )

    def binned(i: int, series: str, x: str) -> str:
        lo, width = f"spec.r{i}.lo", f"((spec.r{i}.hi - spec.r{i}.lo) / {bins})"
        slot = f"if({width} > 0, least(floor((CAST({x} AS DOUBLE) - {lo}) / {width}), {bins - 1}), 0)"
        return f"named_struct('series', '{series}', 'bin', CAST(if(({x}) IS NULL, NULL, {slot}) AS INT))"

    rows = ", ".join(binned(i, series, x) for i, (series, x) in named)
    counts = (
        with_one_row(df, stats, "spec")
        .selectExpr(f"inline(array({rows}))")
        .filter("bin IS NOT NULL")
        .groupBy("series", "bin")
        .agg(F.expr("count(*) AS n"))
    )
    edges = ", ".join(f"named_struct('series', '{s}', 'lo', r{i}.lo, 'hi', r{i}.hi)" for i, (s, _) in named)
    frame = stats.selectExpr(f"inline(array({edges}))").selectExpr(
        "series", f"explode(sequence(0, {bins - 1})) AS bin", "lo", f"(hi - lo) / {bins} AS width"
    )
    return frame.join(counts, ["series", "bin"], "left").selectExpr(
        "series", "bin", "lo + bin * width AS bin_start", "lo + (bin + 1) * width AS bin_end", "coalesce(n, 0L) AS n"
    )


def _kernel_sums(points: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for series, part in batch.groupby("series", sort=False):
                lo, hi, h = (float(part[c].iloc[0]) for c in ("lo", "hi", "h"))
                grid = np.linspace(lo, hi, points)
                x, n = part["value"].to_numpy(), part["n"].to_numpy()
                acc = totals.setdefault(series, np.zeros(points))
                for start in range(0, len(x), 8192):
                    z = (grid[:, None] - x[None, start : start + 8192]) / h
                    acc += np.exp(-0.5 * z * z) @ n[start : start + 8192]
        for series, acc in totals.items():
            yield pd.DataFrame({"series": series, "point": np.arange(points), "total": acc})

    return run


def kernel_density(df: DataFrame, columns: list[str], points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum.

    The bandwidth is Scott's rule, ``n**(-1/5)`` sample deviations.  Equal
    values are counted first; each task then returns one partial sum per grid
    point, so what is exchanged does not grow with the data.
    """
    x = {c: F.col(c).cast("double") for c in columns}
    stats = df.agg(
        *[
            F.struct(
                F.count(x[c]).cast("double").alias("n"),
                F.min(x[c]).alias("lo"),
                F.max(x[c]).alias("hi"),
                (F.stddev_samp(x[c]) * F.pow(F.count(x[c]).cast("double"), F.lit(-0.2))).alias("h"),
            ).alias(f"r{i}")
            for i, c in enumerate(columns)
        ]
    ).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("series"), f"r{i}.n", f"r{i}.lo", f"r{i}.hi", f"r{i}.h") for i, c in enumerate(columns)
    ])))
    values = (
        df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("series"), x[c].alias("value")) for c in columns])))
        .filter(F.col("value").isNotNull())
        .groupBy("series", "value")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    # one row per column of the report
    per_series = F.broadcast(stats.select("series", "lo", "hi", "h"))
    sums = (
        values.join(per_series, "series")
        .mapInPandas(_kernel_sums(points), "series string, point int, total double")
        .groupBy("series", "point")
        .agg(F.sum("total").alias("total"))
    )
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    return sums.join(F.broadcast(stats), "series").select(
        "series",
        "point",
        (F.col("lo") + F.col("point") * step).alias("x"),
        (F.col("total") / (F.col("n") * F.col("h") * F.sqrt(2 * F.pi()))).alias("density"),
    )
