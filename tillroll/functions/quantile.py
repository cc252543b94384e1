"""Exact percentiles of large columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


ACCURACY = 100_000


def rank_sketches(df: DataFrame, wanted: dict[str, list[float]], accuracy: int = ACCURACY, also: list[Column] = ()) -> DataFrame:
    """One row with a sketch of every column, and whatever other aggregates the same pass should take."""
    margin = 3.0 / accuracy

    def sketch(c: str) -> str:
        edges = ", ".join(f"{min(max(q + side, 0.0), 1.0)!r}D" for q in wanted[c] for side in (-margin, margin))
        x = f"CAST(`{c}` AS DOUBLE)"
        return (
            f"named_struct('n', count({x}), 'min', min({x}), 'max', max({x}), "
            f"'edges', percentile_approx({x}, array({edges}), {accuracy})) AS `{c}`"
        )

    return df.agg(*[F.expr(sketch(c)) for c in wanted], *also)


def exact_percentiles(
    df: DataFrame, wanted: dict[str, list[float]], accuracy: int = ACCURACY, sketched: DataFrame | None = None
) -> DataFrame:
    """Percentiles with linear interpolation, as rows ``(column, q, value)``.

    Spark's ``percentile`` keeps all distinct values of a column in one
    buffer.  Here a first pass brackets every wanted rank with the mergeable
    ``percentile_approx`` sketch, whose rank error is at most
    ``count / accuracy``.  A second pass counts what lies below the bracket and
    the values inside it, combined on the map side.  Only the bracket, some
    ``8 / accuracy`` of the rows, is then ordered.  A column of up to
    ``accuracy`` values is its own bracket.  The sketch only decides where to
    look: the result is exact, and a bracket that missed would raise.  Pass a
    stored row of ``rank_sketches`` as ``sketched`` to save the first pass.
    """
    targets = [(c, q) for c, qs in wanted.items() for q in qs]
    margin = 3.0 / accuracy

    def bracket(i: int, c: str, q: float) -> str:
        at = 2 * wanted[c].index(q)
        lo = f"`{c}`.min" if q <= margin else f"if(`{c}`.n <= {accuracy}, `{c}`.min, `{c}`.edges[{at}])"
        hi = f"`{c}`.max" if q >= 1 - margin else f"if(`{c}`.n <= {accuracy}, `{c}`.max, `{c}`.edges[{at + 1}])"
        return (
            f"named_struct('target', {i}, 'column', '{c}', 'q', {float(q)!r}D, 'last', `{c}`.n, 'lo', {lo}, 'hi', {hi})"
        )

    # one sketch per column answers all its ranks; one row per target after that
    sketched = rank_sketches(df, wanted, accuracy) if sketched is None else sketched
    listed = ", ".join(bracket(i, c, q) for i, (c, q) in enumerate(targets))
    brackets = F.broadcast(sketched.selectExpr(f"inline(array({listed}))"))
    probes = ", ".join(f"named_struct('target', {i}, 'x', CAST(`{c}` AS DOUBLE))" for i, (c, _) in enumerate(targets))
    counted = (
        df.selectExpr(f"inline(array({probes}))")
        .join(brackets.select("target", "lo", "hi"), "target")
        .filter("x <= hi")
        .groupBy("target", F.expr("CASE WHEN x >= lo THEN x END").alias("v"))
        .agg(F.expr("count(*) AS n"))
    )
    running = Window.partitionBy("target").orderBy(F.col("v").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    located = (
        counted.withColumn("upto", F.sum("n").over(running))
        .join(brackets.select("target", "column", "q", "last"), "target")
        .selectExpr("column", "q", "upto", "v", "last", "(last - 1) * q AS place", "floor((last - 1) * q) AS k")
    )
    picked = located.groupBy("column", "q").agg(
        F.expr("max(place - k) AS part"),
        F.expr("min(CASE WHEN upto >= k + 1 THEN struct(upto, v) END) AS a"),
        F.expr("min(CASE WHEN upto >= least(k + 2, last) THEN struct(upto, v) END) AS b"),
    )
    return picked.selectExpr(
        "column",
        "q",
        """CASE WHEN a.v IS NOT NULL AND b.v IS NOT NULL THEN a.v + (b.v - a.v) * part
            ELSE CAST(raise_error('percentile bracket missed its rank') AS DOUBLE) END AS value""",
    )
