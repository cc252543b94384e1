"""Who bought what: the tables all recommenders start from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import durable


def purchase_counts(lines: DataFrame, by: str = "customer_id") -> DataFrame:
    """Lines per (description, customer) or (description, invoice).

    Reduced on the map side, so a best-seller's lines are already merged per
    customer when they are exchanged.
    """
    return (
        lines.filter(F.col(by).isNotNull() & F.col("description").isNotNull())
        .groupBy("description", by)
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


def stored_counts(lines: DataFrame, by: str = "customer_id") -> DataFrame:
    """``purchase_counts`` as a stored table.

    The recommenders read it several times (popularity, item keys, pairs), and
    the lines only this once.
    """
    return durable(purchase_counts(lines, by), "counts")


def popular_items(lines: DataFrame, min_purchases: int = 5) -> DataFrame:
    """Descriptions with at least ``min_purchases`` lines, with their line count."""
    return (
        lines.groupBy("description")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .filter(F.col("n_lines") >= min_purchases)
    )


def keep_popular(counts: DataFrame, min_purchases: int) -> DataFrame:
    """The rows of ``purchase_counts`` whose description has enough lines.

    These descriptions are stored, so their size is known when the join is
    planned: while they are few, the counts aren't exchanged to meet them.
    """
    popular = (
        counts.groupBy("description")
        .agg(F.sum("n_lines").alias("total"))
        .filter(F.col("total") >= min_purchases)
        .select("description")
    )
    return counts.join(durable(popular, "popular"), "description", "left_semi")


def binary_interactions(counts: DataFrame, min_purchases: int = 5) -> DataFrame:
    """Distinct (description, customer) of the popular items."""
    return keep_popular(counts, min_purchases).select("description", "customer_id")


def bestsellers(lines: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` items with most lines: ``(rank, item, n_lines)``."""
    top = (
        lines.groupBy("description")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .orderBy(F.desc("n_lines"), "description")
        .limit(n)
    )
    # n rows at most; their rank is the place in one small array
    listed = top.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("n_lines")).alias("o"), "description", "n_lines"))).alias("l")
    )
    return listed.select(F.posexplode("l").alias("pos", "e")).select(
        (F.col("pos") + 1).alias("rank"), F.col("e.description").alias("item"), F.col("e.n_lines").alias("n_lines")
    )


def catalog(lines: DataFrame) -> DataFrame:
    """All descriptions, sorted."""
    return lines.select("description").distinct().orderBy("description")


def listed_items(recommendations: DataFrame) -> DataFrame:
    """Descriptions that have a list of recommendations, sorted."""
    return recommendations.select("description").distinct().orderBy("description")


def customer_list(lines: DataFrame) -> DataFrame:
    """All customer numbers, sorted."""
    return lines.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct().orderBy("customer_id")


def lookup_or_fallback(
    requests: DataFrame, recommendations: DataFrame, fallback: DataFrame, key: str, values: list[str]
) -> DataFrame:
    """Recommendations for each requested key, or the fallback list when it has none.

    ``recommendations`` is ``(key, rank, values...)`` and ``fallback`` the short
    bestseller table ``(rank, values...)``.  The fallback travels as one array
    value, so requests are joined once and with nothing else.
    """
    columns = ["rank", *values]
    listed = fallback.agg(F.array_sort(F.collect_list(F.struct(*columns)))).scalar()
    joined = requests.join(recommendations.select(key, *columns), key, "left")
    chosen = F.when(F.col("rank").isNull(), listed).otherwise(F.array(F.struct(*columns)))
    marked = joined.select(key, F.col("rank").isNull().alias("is_fallback"), chosen.alias("chosen"))
    return marked.select(key, "is_fallback", F.inline("chosen"))
