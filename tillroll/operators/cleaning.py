"""Cleaning of raw invoice lines.

The steps are plain filters and projections, so Catalyst folds them into one
scan-side stage; the only shuffle is the full-row dedupe, which combines equal
rows before they are exchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.quantile import exact_percentiles, rank_sketches
from tillroll.functions.text import contains_any, parse_mixed_timestamp, tidy_description
from tillroll.schema import ADMIN_KEYWORDS, ADMIN_STOCK_CODES, CANCEL_PREFIX, GIFT_PREFIX, LINE_COLUMNS
from tillroll.session import durable


def drop_copies(lines: DataFrame) -> DataFrame:
    """One row per set of rows equal in all columns (nulls are equal)."""
    return lines.dropDuplicates()


def has_customer() -> Column:
    return F.col("customer_id").isNotNull() & ~F.isnan(F.col("customer_id").cast("double"))


def keep_known_customers(lines: DataFrame) -> DataFrame:
    """Rows with a customer number, which becomes an integer."""
    return lines.filter(has_customer()).withColumn("customer_id", F.col("customer_id").cast("bigint"))


def pre_cancellation(raw: DataFrame) -> DataFrame:
    """Deduplicated lines of known customers, cancellations and charges included."""
    return keep_known_customers(drop_copies(raw))


def clean_description(lines: DataFrame) -> DataFrame:
    """Upper-case, trimmed descriptions; a missing one becomes the text NAN."""
    return lines.withColumn("description", tidy_description(F.col("description")))


def _true(test: Column) -> Column:
    """The test, with unknown counted as false: a null value is never dropped."""
    return F.coalesce(test, F.lit(False))


def is_admin_code(codes: list[str] = ADMIN_STOCK_CODES, prefix: str = GIFT_PREFIX) -> Column:
    code = F.col("stock_code")
    return _true(code.isin(codes)) | _true(code.startswith(prefix))


def is_admin_text(keywords: list[str] = ADMIN_KEYWORDS) -> Column:
    """Literal, case-insensitive substring test on the description."""
    return _true(contains_any("description", keywords))


def is_cancelled() -> Column:
    return _true(F.col("invoice_no").startswith(CANCEL_PREFIX))


def drop_admin_codes(lines: DataFrame, codes: list[str] = ADMIN_STOCK_CODES) -> DataFrame:
    return lines.filter(~is_admin_code(codes))


def drop_admin_texts(lines: DataFrame, keywords: list[str] = ADMIN_KEYWORDS) -> DataFrame:
    return lines.filter(~is_admin_text(keywords))


def drop_cancelled(lines: DataFrame) -> DataFrame:
    return lines.filter(~is_cancelled())


def add_line_amount(lines: DataFrame) -> DataFrame:
    return lines.withColumn("total_amount", F.col("quantity") * F.col("unit_price"))


def parse_dates(lines: DataFrame) -> DataFrame:
    """Timestamps from text in mixed formats; text that fits none fails the job."""
    if isinstance(lines.schema["invoice_date"].dataType, (T.TimestampType, T.TimestampNTZType)):
        return lines
    return lines.withColumn("invoice_date", parse_mixed_timestamp(F.col("invoice_date")))


def is_purchase() -> Column:
    return (F.col("quantity") > 0) & (F.col("unit_price") > 0)


def purchases_only(cleaned: DataFrame) -> DataFrame:
    return cleaned.filter(is_purchase())


def clean_lines(
    raw: DataFrame,
    codes: list[str] = ADMIN_STOCK_CODES,
    keywords: list[str] = ADMIN_KEYWORDS,
    drop_null_description: bool = False,
    before: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole chain: ``(cleaned, purchases, pre_cancellation)``, all lazy.

    Pass ``before``, a stored ``pre_cancellation`` of ``raw``, where it is read
    for more than the cleaned lines: the history is then deduplicated once.
    """
    before = pre_cancellation(raw) if before is None else before
    kept = before.filter(F.col("description").isNotNull()) if drop_null_description else before
    kept = clean_description(kept)
    kept = drop_cancelled(drop_admin_texts(drop_admin_codes(kept, codes), keywords))
    cleaned = parse_dates(add_line_amount(kept))
    return cleaned, purchases_only(cleaned), before


def marked_lines(before: DataFrame) -> DataFrame:
    """The lines of ``pre_cancellation`` with tidy descriptions and dates, and in ``kept`` whether cleaning keeps them.

    Stored once, it serves both the cleaned lines and the return ratio.  The
    line's amount follows from two columns, so ``kept_lines`` adds it on reading.
    """
    tidy = parse_dates(clean_description(before))
    return tidy.withColumn("kept", ~(is_admin_code() | is_admin_text() | is_cancelled()))


def kept_lines(marked: DataFrame) -> DataFrame:
    """The cleaned lines among ``marked_lines``."""
    return add_line_amount(marked.filter("kept").drop("kept"))


AUDIT_STAGES = ["copies", "no_customer", "admin_code", "admin_text", "cancelled", "not_purchase", "purchase"]


def rejecting_rule() -> Column:
    """The first rule that rejects a line with a tidy description, or what it is otherwise."""
    return (
        F.when(~has_customer(), "no_customer")
        .when(is_admin_code(), "admin_code")
        .when(is_admin_text(), "admin_text")
        .when(is_cancelled(), "cancelled")
        .when(~_true(is_purchase()), "not_purchase")
        .otherwise("purchase")
    )


def clean_lines_observed(raw: DataFrame, store: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``(cleaned, audit)`` from one pass: the counts of ``clean_audit`` are taken while the lines are cleaned and written.

    ``store`` writes a table and reads it back; counts are known once it has run.  The counters travel with the tasks'
    results, so a lost executor's rows aren't counted twice.
    """
    arriving, judging = Observation(), Observation()
    lines = drop_copies(raw.observe(arriving, F.count(F.lit(1)).alias("rows")))
    judged = clean_description(lines).withColumn("stage", rejecting_rule())
    judged = judged.observe(judging, *[F.count_if(F.col("stage") == s).alias(s) for s in AUDIT_STAGES[1:]])
    kept = judged.filter(F.col("stage").isin("not_purchase", "purchase")).drop("stage")
    kept = kept.withColumn("customer_id", F.col("customer_id").cast("bigint"))
    cleaned = store(parse_dates(add_line_amount(kept)))
    counts = judging.get
    counts["copies"] = arriving.get["rows"] - sum(counts.values())
    rows = [(i, stage, counts[stage]) for i, stage in enumerate(AUDIT_STAGES, 1) if counts[stage] or stage == "copies"]
    return cleaned, raw.sparkSession.createDataFrame(rows, "step int, stage string, rows bigint")


def clean_audit(raw: DataFrame) -> DataFrame:
    """Rows removed by each rule, in rule order, and the rows left, in one pass.

    Equal rows are counted together, so copies collapse on the map side; each
    distinct row is then charged to the first rule that rejects it.
    """
    distinct_rows = raw.groupBy(*LINE_COLUMNS).agg(F.count(F.lit(1)).alias("copies"))
    per_rule = (
        clean_description(distinct_rows)
        .groupBy(rejecting_rule().alias("stage"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("copies") - 1).alias("extra"))
    )
    counted = per_rule.select(
        F.inline(
            F.array(
                F.struct(F.col("stage"), F.col("rows")),
                F.struct(F.lit("copies").alias("stage"), F.col("extra").alias("rows")),
            )
        )
    )
    order = F.array_position(F.array(*[F.lit(s) for s in AUDIT_STAGES]), F.col("stage"))
    return (
        counted.groupBy("stage")
        .agg(F.sum("rows").alias("rows"))
        .select(order.cast("int").alias("step"), "stage", "rows")
    )


def profile_all(lines: DataFrame) -> DataFrame:
    """Type, rows with a value and rows without one of every column, in one pass: ``(column, type, non_null, nulls)``."""
    counts = lines.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{c}") for c in lines.columns])
    entries = ", ".join(
        f"struct('{f.name}' AS column, '{f.dataType.simpleString()}' AS type, n_{f.name} AS non_null, rows - n_{f.name} AS nulls)"
        for f in lines.schema
    )
    return counts.selectExpr(f"inline(array({entries}))")


def profile_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per numeric column: counts, nulls, mean, deviation, extremes and quartiles.

    One row per column.  The quartiles are exact (linear interpolation) and
    found without sorting or collecting the column, see ``exact_percentiles``.
    The other figures are taken by its first pass, so ``df`` is read twice.
    """
    quarters = [0.25, 0.5, 0.75]
    wanted = {c: quarters for c in columns}
    figures = [
        F.expr(
            f"""named_struct('column', '{c}', 'non_null', count(`{c}`), 'nulls', count_if(`{c}` IS NULL),
                'mean', avg(CAST(`{c}` AS DOUBLE)), 'std', stddev_samp(CAST(`{c}` AS DOUBLE)),
                'min', min(CAST(`{c}` AS DOUBLE)), 'max', max(CAST(`{c}` AS DOUBLE))) AS `figures_{c}`"""
        )
        for c in columns
    ]
    sketched = durable(rank_sketches(df, wanted, also=figures), "profile")
    basic = sketched.select(F.inline(F.array(*[f"figures_{c}" for c in columns])))
    cuts = exact_percentiles(df, wanted, sketched=sketched)
    wide = cuts.groupBy("column").agg(
        *[F.expr(f"max(CASE WHEN q = {q!r}D THEN value END) AS p{int(q * 100)}") for q in quarters]
    )
    return basic.join(wide, "column", "left").select(
        "column", "non_null", "nulls", "mean", "std", "min", "p25", "p50", "p75", "max"
    )
