"""Customer-to-customer collaborative filtering, from ``interactions.stored_counts``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.operators.interactions import bestsellers, binary_interactions
from tillroll.operators.pairs import BLOCK_ROWS, nearest_rows


def nearest_customers(
    counts: DataFrame,
    n: int = 5,
    min_purchases: int = 3,
    targets: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``n`` customers whose item sets are most similar (cosine)."""
    bought = binary_interactions(counts, min_purchases)
    lengths = bought.groupBy("customer_id").agg(F.sqrt(F.count(F.lit(1)).cast("double")).alias("length"))
    vectors = bought.join(lengths, "customer_id").select(
        "customer_id", "description", (F.lit(1.0) / F.col("length")).alias("weight")
    )
    return nearest_rows(vectors, "customer_id", "description", "weight", n, targets, block_rows)


def recommend_from_neighbors(
    counts: DataFrame,
    neighbors: DataFrame,
    n: int = 5,
    min_purchases: int = 3,
) -> DataFrame:
    """Items the neighbours bought and the customer did not, by share of neighbours."""
    bought = binary_interactions(counts, min_purchases)
    asked = neighbors.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_neighbors"))
    offered = (
        neighbors.select("customer_id", "neighbor")
        .join(bought.withColumnRenamed("customer_id", "neighbor"), "neighbor")
        .groupBy("customer_id", "description")
        .agg(F.count(F.lit(1)).alias("buyers"))
        .join(bought, ["customer_id", "description"], "left_anti")
        .join(asked, "customer_id")
        .withColumn("share", F.col("buyers") / F.col("n_neighbors"))
    )
    order = Window.partitionBy("customer_id").orderBy(F.desc("share"), "description")
    return (
        offered.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("customer_id", "rank", F.col("description").alias("item"), F.round("share", 2).alias("score"))
    )


def customer_fallback(lines: DataFrame, n: int = 5) -> DataFrame:
    """Bestsellers with score 1, for customers without purchases."""
    return bestsellers(lines, n).select("rank", "item", F.lit(1.0).alias("score"))
