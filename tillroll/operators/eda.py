"""Report queries over the cleaned lines.

Each one is a single aggregation with map-side combining; the ranked ones end
in ``orderBy().limit()``, which Spark runs as a top-k without a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.histogram import histograms
from tillroll.functions.sampling import sample_exact
from tillroll.operators.rfm import RFM
from tillroll.schema import REPORT_WEEKDAYS


def _ranked(lines: DataFrame, key: str, measure: Column, name: str, n: int) -> DataFrame:
    return lines.groupBy(key).agg(measure.alias(name)).orderBy(F.desc(name), key).limit(n)


def top_countries_by_lines(lines: DataFrame, n: int = 10) -> DataFrame:
    return _ranked(lines, "country", F.count(F.lit(1)), "n_lines", n)


def top_countries_by_revenue(lines: DataFrame, n: int = 10) -> DataFrame:
    return _ranked(lines, "country", F.sum("total_amount"), "revenue", n)


def average_order_value_by_country(lines: DataFrame, n: int = 10) -> DataFrame:
    """Mean invoice total per country: invoice totals first, then their mean."""
    invoices = lines.groupBy("country", "invoice_no").agg(F.sum("total_amount").alias("invoice_total"))
    invoices = invoices.filter(F.col("invoice_no").isNotNull())
    return _ranked(invoices, "country", F.avg("invoice_total"), "avg_order_value", n)


def top_products_by_quantity(lines: DataFrame, n: int = 10) -> DataFrame:
    return _ranked(lines, "description", F.sum("quantity"), "sum_qty", n)


def top_products_by_revenue(lines: DataFrame, n: int = 10) -> DataFrame:
    return _ranked(lines, "description", F.sum("total_amount"), "revenue", n)


def unit_price_histogram(lines: DataFrame, limit: float = 15.0) -> DataFrame:
    return histograms(lines, {"unit_price": f"CASE WHEN unit_price <= {limit} THEN unit_price END"})


def quantity_histogram(lines: DataFrame, limit: int = 50) -> DataFrame:
    return histograms(lines, {"quantity": f"CASE WHEN quantity <= {limit} THEN quantity END"})


def line_value_histogram(lines: DataFrame, limit: float | None = None) -> DataFrame:
    """Values of lines with positive quantity, over their full range or up to ``limit``."""
    kept = "quantity > 0" if limit is None else f"quantity > 0 AND total_amount <= {limit}"
    return histograms(lines, {"line_value": f"CASE WHEN {kept} THEN total_amount END"})


def rfm_histograms(rfm: DataFrame) -> DataFrame:
    """Histograms of recency, frequency, monetary value and their log1p."""
    series = {c: c for c in RFM}
    series.update({f"log_{c}": f"log1p({c})" for c in RFM})
    return histograms(rfm, series)


def _month() -> Column:
    return F.date_format("invoice_date", "yyyy-MM")


def monthly_revenue(lines: DataFrame, positive_only: bool = True) -> DataFrame:
    kept = lines.filter(F.col("quantity") > 0) if positive_only else lines
    return kept.groupBy(_month().alias("month")).agg(F.sum("total_amount").alias("revenue"))


def monthly_orders(lines: DataFrame, positive_only: bool = True) -> DataFrame:
    kept = lines.filter(F.col("quantity") > 0) if positive_only else lines
    return kept.groupBy(_month().alias("month")).agg(F.count_distinct("invoice_no").alias("orders"))


def orders_by_weekday(lines: DataFrame, days: list[str] = REPORT_WEEKDAYS) -> DataFrame:
    """Distinct invoices per weekday, in report order; a day without any is null."""
    counts = lines.groupBy(F.date_format("invoice_date", "EEEE").alias("weekday")).agg(
        F.count_distinct("invoice_no").alias("orders")
    )
    frame = lines.sparkSession.createDataFrame(list(enumerate(days)), "day_order int, weekday string")
    return frame.join(counts, "weekday", "left").select("day_order", "weekday", "orders")


def orders_by_hour(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.hour("invoice_date").alias("hour")).agg(
        F.count_distinct("invoice_no").alias("orders")
    )


# What makes a line's place in the seeded sample, and what settles equal keys.
SAMPLE_KEY = ["invoice_no", "stock_code", "quantity", "description"]


def price_quantity_sample(lines: DataFrame, n: int = 1000, max_price: float = 50.0, seed: int = 42) -> DataFrame:
    """Seeded sample of ``n`` lines, of which those up to ``max_price`` are kept."""
    columns = [*SAMPLE_KEY, "unit_price", "total_amount"]
    drawn = sample_exact(lines.select(*columns), n, SAMPLE_KEY, seed, ties=["unit_price"])
    return drawn.filter(F.col("unit_price") <= max_price).select("unit_price", "quantity", "total_amount")


def new_customers_by_month(lines: DataFrame) -> DataFrame:
    """Customers by the month of their first line."""
    first = lines.groupBy("customer_id").agg(F.min("invoice_date").alias("first_date"))
    return first.groupBy(F.date_format("first_date", "yyyy-MM").alias("cohort_month")).agg(
        F.count("customer_id").alias("new_customers")
    )


def with_first_purchase_month(lines: DataFrame) -> DataFrame:
    """Lines with the month of their customer's first line attached.

    An aggregate joined back instead of a window over the customer: a window
    would put all lines of a very large customer into one task, while the join
    is broadcast when the customers are few and split by AQE when they are not.
    """
    first = lines.groupBy("customer_id").agg(
        F.date_format(F.min("invoice_date"), "yyyy-MM").alias("first_purchase_month")
    )
    return lines.join(first, "customer_id")


def rfm_correlation(rfm: DataFrame) -> DataFrame:
    """Pearson correlations of the RFM columns, as rows (a, b, corr)."""
    pairs = [(a, b) for i, a in enumerate(RFM) for b in RFM[i:]]
    one = rfm.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}_{b}") for a, b in pairs]
    )
    cells = {(a, b): F.col(f"{a}_{b}") for a, b in pairs}
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("a"),
                        F.lit(b).alias("b"),
                        cells.get((a, b), cells.get((b, a))).alias("corr"),
                    )
                    for a in RFM
                    for b in RFM
                ]
            )
        )
    )
