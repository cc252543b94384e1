"""Recency, frequency, monetary value and return ratio per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.onerow import with_one_row
from tillroll.functions.quantile import exact_percentiles

RFM = ["recency", "frequency", "monetary"]


def rfm_base(lines: DataFrame, positive_only: bool = True) -> DataFrame:
    """One row per customer, uncapped.

    Recency is the number of whole 24-hour periods between the customer's last
    line and the last line of all.  The distinct invoice count is planned over
    (customer, invoice) first, so one very large customer is spread over tasks
    before its few sub-totals meet.
    """
    latest = lines.agg(F.max("invoice_date").alias("latest"))
    per_customer = lines.groupBy("customer_id").agg(
        F.max("invoice_date").alias("last_date"),
        F.count_distinct("invoice_no").alias("frequency"),
        F.sum("total_amount").alias("monetary"),
    )
    rfm = per_customer.select(
        "customer_id",
        F.timestamp_diff("DAY", F.col("last_date"), latest.scalar()).cast("bigint").alias("recency"),
        "frequency",
        "monetary",
    )
    return rfm.filter(F.col("monetary") > 0) if positive_only else rfm


def return_ratio(pre_cancellation: DataFrame) -> DataFrame:
    """Share of a customer's invoices that contain a negative quantity.

    Two plain levels, invoice then customer: no row expansion, and the large
    groups are reduced before they meet.
    """
    invoices = pre_cancellation.groupBy("customer_id", "invoice_no").agg(
        F.max(F.coalesce(F.col("quantity") < 0, F.lit(False))).alias("returned")
    )
    counted = F.col("invoice_no").isNotNull()
    return invoices.groupBy("customer_id").agg(
        F.coalesce(
            F.try_divide(F.count_if(counted & F.col("returned")), F.count_if(counted)), F.lit(0.0)
        ).alias("return_ratio")
    )


def rfm_with_returns(purchases: DataFrame, pre_cancellation: DataFrame) -> DataFrame:
    """RFM with the return ratio attached; a customer without returns has 0."""
    return (
        rfm_base(purchases)
        .join(return_ratio(pre_cancellation), "customer_id", "left")
        .withColumn("return_ratio", F.coalesce("return_ratio", F.lit(0.0)))
    )


def cap_upper(df: DataFrame, columns: list[str] = RFM, q: float = 0.995) -> DataFrame:
    """Clip each column at its ``q`` percentile (linear interpolation).

    Reads ``df`` three times: pass a stored table when it is costly to compute.
    """
    cuts = exact_percentiles(df, {c: [q] for c in columns})
    caps = cuts.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])
    capped = {c: F.least(F.col(c).cast("double"), F.col(f"caps.{c}")) for c in columns}
    return with_one_row(df, caps, "caps").withColumns(capped).drop("caps")
