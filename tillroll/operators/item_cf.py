"""Item-to-item collaborative filtering, from ``interactions.stored_counts``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions.ids import with_integer_ids
from tillroll.operators.interactions import keep_popular
from tillroll.operators.pairs import both_ways, co_occurrence


def _cosine(counts: DataFrame, weighted: bool, **cutting) -> tuple[DataFrame, DataFrame]:
    """Cosine similarity of all item pairs with a common customer, each pair once.

    Returns ``(a, b, together, similarity)`` by item number, and the items
    ``(description, square, item)``.
    """
    rows = counts.selectExpr(
        "description", "customer_id", ("CAST(n_lines AS DOUBLE)" if weighted else "1D") + " AS weight"
    )
    items = with_integer_ids(
        rows.groupBy("description").agg(F.expr("sum(weight * weight) AS square")), "description", "item"
    )
    members = rows.join(items, "description").selectExpr("customer_id AS grp", "item", "weight", "square")
    pairs = co_occurrence(members, **cutting).selectExpr(
        "a", "b", "together", "together / sqrt(square_a * square_b) AS similarity"
    )
    return pairs, items


def _named(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """Descriptions in place of item numbers."""
    return (
        pairs.join(items.selectExpr("item AS a", "description AS item_a"), "a")
        .join(items.selectExpr("item AS b", "description AS item_b"), "b")
        .drop("a", "b")
    )


def item_cosine(counts: DataFrame, min_purchases: int = 5, **cutting) -> DataFrame:
    """Similarity of popular items by the customers they share, both ways round."""
    pairs, items = _cosine(keep_popular(counts, min_purchases), weighted=False, **cutting)
    named = _named(pairs, items).withColumn("common", F.expr("CAST(together AS BIGINT)"))
    return both_ways(named, [("item_a", "item_b")], ["common", "similarity"])


def _top(similar: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("item_a").orderBy(F.desc("similarity"), "item_b")
    return (
        similar.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .selectExpr("item_a AS description", "rank", "item_b AS item", "similarity AS score")
    )


def _top_of_pairs(pairs: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """The best ``n`` of each item.

    A first cut by number keeps everything that ties with the n-th, so only
    those few rows are given names, which settle the ties.
    """
    by_number = Window.partitionBy("a").orderBy(F.desc("similarity"))
    leaders = (
        both_ways(pairs, [("a", "b")], ["similarity"])
        .withColumn("place", F.rank().over(by_number))
        .filter(F.col("place") <= n)
        .drop("place")
    )
    return _top(_named(leaders, items), n)


def similar_items(counts: DataFrame, n: int = 5, min_purchases: int = 5, **cutting) -> DataFrame:
    """The ``n`` most similar items of each popular item."""
    pairs, items = _cosine(keep_popular(counts, min_purchases), weighted=False, **cutting)
    return _top_of_pairs(pairs, items, n)


def similar_items_weighted(
    counts: DataFrame, n: int = 5, targets: DataFrame | None = None, **cutting
) -> DataFrame:
    """As ``similar_items`` over line counts instead of yes/no, with no popularity limit.

    With ``targets`` (a ``description`` column) only customers who bought a
    target are looked at.
    """
    if targets is None:
        pairs, items = _cosine(counts, weighted=True, **cutting)
        return _top_of_pairs(pairs, items, n)
    squares = counts.groupBy("description").agg(
        F.sum(F.col("n_lines").cast("double") * F.col("n_lines")).alias("square")
    )
    asked = counts.join(targets.select("description").distinct(), "description", "left_semi")
    dots = (
        asked.select("customer_id", F.col("description").alias("item_a"), F.col("n_lines").cast("double").alias("wa"))
        .join(counts.withColumnRenamed("description", "item_b"), "customer_id")
        .filter(F.col("item_a") != F.col("item_b"))
        .groupBy("item_a", "item_b")
        .agg(F.sum(F.col("wa") * F.col("n_lines")).alias("dot"))
    )
    named = lambda side: squares.select(
        F.col("description").alias(f"item_{side}"), F.col("square").alias(f"square_{side}")
    )
    similar = dots.join(named("a"), "item_a").join(named("b"), "item_b")
    return _top(
        similar.withColumn("similarity", F.col("dot") / F.sqrt(F.col("square_a") * F.col("square_b"))), n
    )
