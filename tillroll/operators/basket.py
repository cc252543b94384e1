"""Market-basket rules between pairs of items.

``counts`` is ``interactions.stored_counts`` by invoice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.ids import with_integer_ids
from tillroll.operators.interactions import bestsellers, keep_popular
from tillroll.operators.pairs import both_ways, co_occurrence


def baskets(counts: DataFrame, min_lines: int = 5) -> DataFrame:
    """Distinct (invoice, description) of the items with at least ``min_lines`` lines."""
    return keep_popular(counts, min_lines).select("invoice_no", "description")


def _counted_pairs(held: DataFrame, min_together: float, **cutting) -> DataFrame:
    """Unordered item pairs on at least ``min_together`` invoices, with item supports."""
    items = with_integer_ids(
        held.groupBy("description").agg(F.count(F.lit(1)).alias("support")), "description", "item"
    )
    members = held.join(items.select("description", "item"), "description").select(
        F.col("invoice_no").alias("grp"), "item", F.lit(1.0).alias("weight")
    )
    frequent = co_occurrence(members, **cutting).filter(F.col("together") >= min_together)
    named = lambda side: items.select(
        F.col("item").alias(side), F.col("description").alias(f"item_{side}"), F.col("support").alias(f"support_{side}")
    )
    return (
        frequent.join(named("a"), "a")
        .join(named("b"), "b")
        .select("item_a", "item_b", "support_a", "support_b", F.col("together").cast("bigint").alias("co_occurrences"))
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return both_ways(pairs, [("item_a", "item_b"), ("support_a", "support_b")], ["co_occurrences"])


def basket_pairs(counts: DataFrame, min_support: int = 5, **cutting) -> DataFrame:
    """Ordered item pairs bought together on enough invoices."""
    held = baskets(counts, min_support)
    return _ordered(_counted_pairs(held, max(3, min_support // 2), **cutting)).select(
        "item_a", "item_b", "co_occurrences"
    )


def association_rules(counts: DataFrame, min_support: int = 5, **cutting) -> DataFrame:
    """Support, confidence and lift of all ordered pairs of popular items.

    The number of invoices is that of the invoices holding a popular item.
    """
    held = baskets(counts, min_support)
    invoices = held.agg(F.count_distinct("invoice_no").cast("double")).scalar()
    together, a, b = (F.col(c).cast("double") for c in ("co_occurrences", "support_a", "support_b"))
    return _ordered(_counted_pairs(held, max(3, min_support // 2), **cutting)).select(
        "item_a",
        "item_b",
        "co_occurrences",
        "support_a",
        "support_b",
        (together / a).alias("confidence"),
        (together * invoices / (a * b)).alias("lift"),
    )


def top_rules(rules: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best rules of each item, by lift, then confidence."""
    order = Window.partitionBy("item_a").orderBy(F.desc("lift"), F.desc("confidence"), "item_b")
    return (
        rules.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select(F.col("item_a").alias("description"), "rank", F.col("item_b").alias("item"), "lift", "confidence")
    )


def rules_fallback(lines: DataFrame, n: int = 5) -> DataFrame:
    """Bestsellers in the shape of rules, with lift and confidence 1."""
    return bestsellers(lines, n).select(
        "rank", "item", F.lit(1.0).alias("lift"), F.lit(1.0).alias("confidence")
    )


def strongest_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` rules with the highest lift of all."""
    return (
        rules.orderBy(F.desc("lift"), "item_a", "item_b")
        .limit(n)
        .select("item_a", "item_b", "confidence", "lift")
    )


def rules_for_targets(
    lines: DataFrame,
    counts: DataFrame,
    targets: DataFrame | None = None,
    min_support: float = 0.01,
    n: int = 5,
    **cutting,
) -> DataFrame:
    """The best rules of each target item among pairs on a share of all invoices.

    A pair cannot be on more invoices than either item, so items below the
    share are dropped before any pair is formed; that leaves at most
    ``mean basket size / min_support`` items.  ``targets`` (a ``description``
    column) limits the pairs to invoices holding a target.
    """
    held = counts.select("invoice_no", "description")
    total = lines.agg(F.count_distinct("invoice_no").cast("double")).scalar()
    supports = held.groupBy("description").agg(F.count(F.lit(1)).alias("support"))
    able = supports.filter(F.col("support") / total >= min_support)
    kept = held.join(able.select("description"), "description", "left_semi")
    if targets is not None:
        wanted = targets.select("description").distinct()
        theirs = kept.join(wanted, "description", "left_semi").select("invoice_no").distinct()
        kept = kept.join(theirs, "invoice_no", "left_semi")
    items = with_integer_ids(able, "description", "item")
    members = kept.join(items.select("description", "item"), "description").select(
        F.col("invoice_no").alias("grp"), "item", F.lit(1.0).alias("weight")
    )
    frequent = co_occurrence(members, **cutting).filter(F.col("together") / total >= min_support)
    named = lambda side: items.select(
        F.col("item").alias(side), F.col("description").alias(f"item_{side}"), F.col("support").alias(f"support_{side}")
    )
    pairs = frequent.join(named("a"), "a").join(named("b"), "b").withColumnRenamed("together", "co_occurrences")
    ordered = _ordered(pairs)
    if targets is not None:
        ordered = ordered.join(wanted.withColumnRenamed("description", "item_a"), "item_a", "left_semi")
    confidence = (F.col("co_occurrences") / total) / (F.col("support_a") / total)
    rules = ordered.withColumn("confidence", confidence).withColumn(
        "lift", F.col("confidence") / (F.col("support_b") / total)
    )
    order = Window.partitionBy("item_a").orderBy(F.desc("lift"), "item_b")
    return (
        rules.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select(F.col("item_a").alias("description"), "rank", F.col("item_b").alias("item"), "lift", "confidence")
    )
