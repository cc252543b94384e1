"""The batch build: raw lines to all result tables and models.

    spark-submit --py-files tillroll.zip tillroll/plans/build.py LINES.csv OUTPUT_DIR
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import basket, cleaning, clv, interactions, item_cf, rfm, segments
from tillroll.session import durable, ship_package, stored_tables
from tillroll.sources import artifacts
from tillroll.sources.lines import scan_csv


def build(
    raw: DataFrame,
    directory: str,
    n_clusters: int = 4,
    min_purchases: int = 5,
    top_n: int = 5,
    clv_months: int = 3,
    clv_discount_rate: float = 0.01,
) -> artifacts.Artifacts:
    """Clean, segment, value and recommend; write every result under ``directory``.

    The raw lines are read and deduplicated once; each later step reads the
    smallest stored table that serves it.  Tables stored on the way are removed
    when the build ends, also by an error.
    """
    with stored_tables(raw.sparkSession):
        return _build(raw, directory, n_clusters, min_purchases, top_n, clv_months, clv_discount_rate)


def _build(
    raw: DataFrame, directory: str, n_clusters: int, min_purchases: int, top_n: int, clv_months: int, clv_discount_rate: float
) -> artifacts.Artifacts:
    spark = raw.sparkSession
    ship_package(spark)
    cleaned, _, before = cleaning.clean_lines(raw, before=durable(cleaning.pre_cancellation(raw), "pre_cancellation"))
    cleaned = artifacts.write_table(cleaned, directory, "cleaned_dataset")
    purchases = cleaning.purchases_only(cleaned)

    features = durable(rfm.rfm_with_returns(purchases, before), "rfm")
    customers = durable(rfm.cap_upper(features), "customers")
    model = segments.fit_segments(customers, n_clusters)
    artifacts.save_segment_model(spark, model, directory)
    segmented = segments.score_segments(customers, model)

    summary = durable(clv.repeat_summary(purchases), "summary")
    purchase_model, value_model = clv.fit_purchase_model(summary), clv.fit_value_model(summary)
    artifacts.save_lifetime_models(spark, purchase_model, value_model, directory)
    valued = clv.add_lifetime_value(summary, purchase_model, value_model, clv_months, clv_discount_rate)
    clustered = artifacts.write_table(clv.attach_lifetime_value(segmented, valued), directory, "rfm_clustered")
    artifacts.write_table(clustered.select(*rfm.RFM), directory, "rfm_data")

    by_customer = interactions.stored_counts(purchases)
    recommended = artifacts.write_table(
        item_cf.similar_items(by_customer, top_n, min_purchases), directory, "recommendations"
    )
    artifacts.write_table(
        interactions.keep_popular(by_customer, min_purchases).select("description").distinct(), directory, "product_list"
    )
    by_invoice = interactions.stored_counts(purchases, "invoice_no")
    rules = basket.top_rules(basket.association_rules(by_invoice, min_purchases), top_n)
    artifacts.write_table(rules, directory, "association_rules")
    artifacts.write_table(interactions.bestsellers(purchases, top_n), directory, "bestsellers")
    return artifacts.load_artifacts(spark, directory)


def recommend(built: artifacts.Artifacts, requests: DataFrame) -> DataFrame:
    """Stored item recommendations for requested descriptions, with the bestseller fallback."""
    best = built.tables["bestsellers"].select("rank", "item", F.col("n_lines").cast("double").alias("score"))
    return interactions.lookup_or_fallback(
        requests, built.tables["recommendations"], best, "description", ["item", "score"]
    )


def recommend_by_rules(built: artifacts.Artifacts, requests: DataFrame) -> DataFrame:
    """Stored basket rules for requested descriptions; bestsellers with lift and confidence 1 for those that have none."""
    best = built.tables["bestsellers"].select("rank", "item", F.lit(1.0).alias("lift"), F.lit(1.0).alias("confidence"))
    return interactions.lookup_or_fallback(requests, built.tables["association_rules"], best, "description", ["item", "lift", "confidence"])


if __name__ == "__main__":
    session = SparkSession.builder.appName("tillroll-build").getOrCreate()
    build(scan_csv(session, sys.argv[1]), sys.argv[2])
