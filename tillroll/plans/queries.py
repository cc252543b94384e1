"""The named queries over a data folder.

Doubles that come out of sums are rounded to 6 decimals, so that the order of
addition does not show.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.histogram import kernel_density
from tillroll.functions.sampling import sample_exact
from tillroll.functions.text import parse_mixed_timestamp
from tillroll.operators import basket, cleaning, clv, content, eda, hypothesis, interactions, item_cf, rfm, segments, sketched, user_cf
from tillroll.plans.tables import Tables
from tillroll.session import durable, shared_dir
from tillroll.schema import LINE_COLUMNS
from tillroll.sources import partitioned
from tillroll.sources.lines import normalize_types, scan_csv, write_csv
from tillroll.sources.quarantine import judge_records, quarantine, reason_counts

# Given parameters, so that scoring can be checked apart from fitting.
GIVEN_CENTRES = [[0.58, -1.68, -1.7], [-1.62, 0.42, 0.39], [0.43, -0.28, -0.22], [0.12, 0.91, 0.87]]
GIVEN_SCALING = {"means": [5.0, 2.25, 7.25], "stds": [1.25, 0.325, 0.44]}
GIVEN_SEGMENTS = {0: "At-Risk", 1: "Regular", 3: "High-Value"}
GIVEN_PURCHASE = clv.PurchaseModel(r=1.4, alpha=10.8, a=0.6, b=2.5)
# Nearly all customers stay: a + b < 1, which customers without repeats feel most.
LOW_DROPOUT = clv.PurchaseModel(r=1.4, alpha=10.8, a=0.3, b=0.5)
GIVEN_VALUE = clv.ValueModel(p=1.5, q=3.2, v=50.0)
LOW_SPREAD = clv.ValueModel(p=0.4, q=0.7, v=5.0)
# Share of invoices for the target rules; the operator's own default is 0.01.
TARGET_SUPPORT = 0.0002
# Popularity limit of the popular-items report; every item here passes the default of 5.
POPULAR_LINES = 20

# Steps of the refinement of given centres.
REFINE_STEPS = 3

UK = "NATION_0"  # the home country in these tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register ``f`` under its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(Tables.of(spark, sf_dir))

    name = f.__name__.removesuffix("_query")
    run.__name__, run.__doc__ = name, f.__doc__
    QUERIES[name] = run
    return f


def settled(df: DataFrame, *skip: str) -> DataFrame:
    """Doubles rounded to 6 decimals, except the columns in ``skip``."""
    return df.selectExpr(
        *[
            f"round(`{f.name}`, 6) AS `{f.name}`" if isinstance(f.dataType, T.DoubleType) and f.name not in skip else f"`{f.name}`"
            for f in df.schema
        ]
    )


def single(df: DataFrame, name: str) -> DataFrame:
    """``name`` in single precision: means of money are often an exact half of a last decimal, which rounding may turn either way."""
    return df.withColumn(name, F.col(name).cast("float").cast("double"))


def as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("invoice_date", F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"))


# sources


@query
def scan_csv_roundtrip(t: Tables) -> DataFrame:
    path = f"{shared_dir(t.spark)}/tillroll/csv-{uuid.uuid4().hex}"
    write_csv(as_text(t.raw), path)
    return scan_csv(t.spark, path)


@query
def normalize_types_query(t: Tables) -> DataFrame:
    doubled = t.customers.withColumns({"recency": F.col("recency") / 2, "frequency": F.col("frequency") / 2})
    return settled(normalize_types(doubled).select("customer_id", "recency", "frequency", "return_ratio"))


@query
def reco_lookup_fallback(t: Tables) -> DataFrame:
    asked = (
        cleaning.clean_description(t.raw).select("description")
        .unionByName(t.source("part").select(F.col("p_name").alias("description")))
        .distinct()
    )
    recs = item_cf.similar_items(interactions.stored_counts(t.purchases))
    best = interactions.bestsellers(t.purchases).select("rank", "item", F.col("n_lines").cast("double").alias("score"))
    return settled(interactions.lookup_or_fallback(asked, recs, best, "description", ["item", "score"]))


def _doubtful(t: Tables) -> DataFrame:
    """The raw lines as CSV records, some of them damaged: by invoice number, a field that can't be read or one too many."""
    number = F.expr("CAST(replace(invoice_no, 'C', '') AS BIGINT)")
    damaged = {"quantity": (89, "x"), "invoice_date": (83, "yesterday "), "unit_price": (79, "about "), "customer_id": (73, "no ")}
    fields = as_text(t.raw).withColumn("n", number)
    for name, (every, word) in damaged.items():
        kept = F.col(name).cast("string")
        fields = fields.withColumn(name, F.when(F.col("n") % every == 3, F.concat(F.lit(word), kept)).otherwise(kept))
    record = F.to_csv(F.struct(*LINE_COLUMNS), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'})
    return fields.select(F.when(F.col("n") % 71 == 3, F.concat(record, F.lit(",surplus"))).otherwise(record).alias("record"))


def _quarantined(t: Tables) -> tuple[DataFrame, DataFrame]:
    return quarantine(judge_records(_doubtful(t), "record"), f"{shared_dir(t.spark)}/tillroll/quarantine-{uuid.uuid4().hex}")


@query
def quarantined_lines(t: Tables) -> DataFrame:
    """Rejected lines with what couldn't be read; of records with too many fields, the last."""
    _, rejected = _quarantined(t)
    last = F.when(F.col("reason") == "malformed", F.element_at(F.split("rejected_text", ","), -1)).otherwise(F.substring_index("rejected_text", " ", 1))
    first = F.when(F.col("reason") == "quantity", F.col("rejected_text")).otherwise(last)
    return rejected.select("reason", "invoice_no", "stock_code", first.alias("rejected"))


@query
def quarantine_counts(t: Tables) -> DataFrame:
    return reason_counts(judge_records(_doubtful(t), "record"))


@query
def quarantine_accepted(t: Tables) -> DataFrame:
    good, _ = _quarantined(t)
    return as_text(good)


# cleaning


@query
def clean_dedupe(t: Tables) -> DataFrame:
    return as_text(cleaning.drop_copies(t.raw))


@query
def clean_customer_not_null(t: Tables) -> DataFrame:
    return as_text(cleaning.keep_known_customers(t.raw))


@query
def pre_cancellation(t: Tables) -> DataFrame:
    return as_text(cleaning.pre_cancellation(t.raw))


@query
def clean_description(t: Tables) -> DataFrame:
    return as_text(cleaning.clean_description(t.raw))


@query
def clean_stock_codes(t: Tables) -> DataFrame:
    return as_text(cleaning.drop_admin_codes(t.raw))


@query
def clean_keywords(t: Tables) -> DataFrame:
    return as_text(cleaning.drop_admin_texts(cleaning.clean_description(t.raw)))


@query
def clean_cancellations(t: Tables) -> DataFrame:
    return as_text(cleaning.drop_cancelled(t.raw))


@query
def line_amount(t: Tables) -> DataFrame:
    return as_text(cleaning.add_line_amount(t.raw))


@query
def parse_mixed_dates(t: Tables) -> DataFrame:
    number = F.regexp_extract("invoice_no", r"(\d+)", 1).cast("bigint")
    text = F.when(number % 2 == 0, F.date_format("invoice_date", "M/d/yyyy H:mm")).otherwise(
        F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss")
    )
    mixed = t.raw.select("invoice_no", "stock_code", "quantity", text.alias("invoice_date"))
    return as_text(mixed.withColumn("invoice_date", parse_mixed_timestamp(F.col("invoice_date"))))


@query
def purchases_only(t: Tables) -> DataFrame:
    return as_text(cleaning.purchases_only(t.raw))


@query
def clean_retail(t: Tables) -> DataFrame:
    return as_text(cleaning.clean_lines(t.raw)[0])


@query
def clean_audit(t: Tables) -> DataFrame:
    return cleaning.clean_audit(t.raw)


SKETCHED = ["unit_price", "quantity", "total_amount"]
QUARTERS = [0.25, 0.5, 0.75, 0.95]


@query
def frequency_sketched(t: Tables) -> DataFrame:
    """Invoices per customer, and whether the union of daily sketches is within its bound of them."""
    checked = sketched.distinct_checked(t.purchases, ["customer_id"], "invoice_no", lambda df: durable(df, "sketches"))
    return checked.select("customer_id", F.col("exact").alias("frequency"), "within_bound")


@query
def country_reach_sketched(t: Tables) -> DataFrame:
    """The same for customers per country, where counts are large."""
    checked = sketched.distinct_checked(t.purchases, ["country"], "customer_id", lambda df: durable(df, "sketches"))
    return checked.select("country", F.col("exact").alias("customers"), "within_bound")


@query
def quantiles_sketched(t: Tables) -> DataFrame:
    """Whether quantiles from merged daily sketches have the ranks that they should have."""
    checked = sketched.quantiles_checked(t.purchases, SKETCHED, QUARTERS, lambda df: durable(df, "sketches"))
    return checked.select("column", "q", "within_bound")


def _months_folder(t: Tables) -> str:
    return f"{shared_dir(t.spark)}/tillroll/months-{uuid.uuid4().hex}"


@query
def months_rebuilt(t: Tables) -> DataFrame:
    """Lines and revenue by month, read from monthly files of which one month was damaged and then rebuilt alone."""
    path = _months_folder(t)
    partitioned.write_months(t.cleaned, path)
    busiest = partitioned.with_month(t.cleaned).groupBy("month").count().orderBy(F.desc("count"), "month").first()["month"]
    wrong = partitioned.with_month(t.cleaned).filter(F.col("month") == busiest).drop("month")
    partitioned.write_months(wrong.withColumn("quantity", F.lit(0)), path)
    partitioned.rebuild_months(t.cleaned, path, [busiest])
    by_month = partitioned.read_months(t.spark, path).groupBy("month")
    return settled(by_month.agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity")))


@query
def bucketed_customer_totals(t: Tables) -> DataFrame:
    """Lines per customer beside the customer's frequency, from two tables bucketed alike."""
    mark = uuid.uuid4().hex
    lines = partitioned.write_bucketed(t.purchases.select("customer_id", "invoice_no"), f"lines_{mark}")
    customers = partitioned.write_bucketed(t.customers.select("customer_id", "frequency"), f"customers_{mark}")
    counted = lines.groupBy("customer_id").agg(F.count(F.lit(1)).alias("lines"))
    return settled(counted.join(customers, "customer_id").select("customer_id", "lines", "frequency"))


@query
def clean_audit_observed(t: Tables) -> DataFrame:
    """The audit as counted by the cleaning job itself."""
    return cleaning.clean_lines_observed(t.raw, lambda df: durable(df, "cleaned"))[1]


@query
def clean_retail_observed(t: Tables) -> DataFrame:
    """The lines that the counting job cleans and writes."""
    return as_text(cleaning.clean_lines_observed(t.raw, lambda df: durable(df, "cleaned"))[0])


@query
def profile_columns(t: Tables) -> DataFrame:
    return settled(cleaning.profile_columns(t.raw, ["quantity", "unit_price", "customer_id"]))


@query
def profile_all_columns(t: Tables) -> DataFrame:
    return cleaning.profile_all(t.raw)


@query
def profile_rfm(t: Tables) -> DataFrame:
    return settled(cleaning.profile_columns(t.customers, [*rfm.RFM, "return_ratio"]))


# customer features


@query
def rfm_base(t: Tables) -> DataFrame:
    return settled(rfm.rfm_base(t.purchases))


@query
def return_ratio(t: Tables) -> DataFrame:
    return settled(rfm.return_ratio(t.before))


@query
def rfm_with_returns(t: Tables) -> DataFrame:
    return settled(rfm.rfm_with_returns(t.purchases, t.before))


@query
def rfm_capped(t: Tables) -> DataFrame:
    return settled(t.capped_rfm())


@query
def rfm_cleaned_basis(t: Tables) -> DataFrame:
    return settled(rfm.rfm_base(t.cleaned, positive_only=False))


# segments


def _assigned(t: Tables) -> DataFrame:
    return segments.assign_clusters(segments.scale_rfm(t.customers), GIVEN_CENTRES)


def _segmented(t: Tables) -> DataFrame:
    assigned = _assigned(t)
    return segments.attach_segments(assigned, segments.label_clusters(segments.cluster_profiles(assigned)))


def _valued(t: Tables) -> DataFrame:
    return clv.add_lifetime_value(clv.repeat_summary(t.purchases), GIVEN_PURCHASE, GIVEN_VALUE)


@query
def rfm_scaled(t: Tables) -> DataFrame:
    return settled(segments.scale_rfm(t.customers).select("customer_id", *segments.SCALED))


@query
def kmeans_segments(t: Tables) -> DataFrame:
    model = segments.fit_segments(t.customers)
    return settled(segments.score_segments(t.customers, model))


@query
def kmeans_inertia(t: Tables) -> DataFrame:
    return settled(segments.inertia(_assigned(t), GIVEN_CENTRES))


@query
def silhouette_sample(t: Tables) -> DataFrame:
    return settled(segments.silhouette_sample(_assigned(t)))


@query
def silhouette_sample_10000(t: Tables) -> DataFrame:
    return settled(segments.silhouette_sample(_assigned(t), n=10_000))


@query
def kmeans_refined(t: Tables) -> DataFrame:
    return settled(segments.refine_centres(segments.scale_rfm(t.customers), GIVEN_CENTRES, steps=REFINE_STEPS))


@query
def cluster_profiles(t: Tables) -> DataFrame:
    return settled(segments.cluster_profiles(_assigned(t)))


@query
def segment_labels(t: Tables) -> DataFrame:
    return segments.label_clusters(segments.cluster_profiles(_assigned(t)))


@query
def segmented_customers(t: Tables) -> DataFrame:
    return settled(_segmented(t).select("customer_id", "cluster", "segment", "monetary"))


@query
def elbow_curve(t: Tables) -> DataFrame:
    return settled(segments.elbow_curve(t.customers))


@query
def elbow_single_cluster(t: Tables) -> DataFrame:
    return settled(segments.elbow_curve(t.customers, ks=range(1, 2)))


@query
def score_segments(t: Tables) -> DataFrame:
    model = segments.SegmentModel(GIVEN_SCALING["means"], GIVEN_SCALING["stds"], GIVEN_CENTRES, GIVEN_SEGMENTS)
    return segments.score_segments(t.customers, model).select("customer_id", "cluster", "segment")


@query
def segment_summary(t: Tables) -> DataFrame:
    return settled(segments.segment_summary(clv.attach_lifetime_value(_segmented(t), _valued(t))))


@query
def segment_distribution(t: Tables) -> DataFrame:
    return segments.segment_distribution(_segmented(t))


@query
def kpi_summary(t: Tables) -> DataFrame:
    return settled(segments.kpi_summary(_segmented(t)))


@query
def sample_exact_n(t: Tables) -> DataFrame:
    columns = [*eda.SAMPLE_KEY, "unit_price"]
    return sample_exact(t.cleaned.select(*columns), 10_000, eda.SAMPLE_KEY, ties=["unit_price"])


@query
def segment_scatter(t: Tables) -> DataFrame:
    return settled(segments.segment_points(_segmented(t)))


@query
def segment_actions(t: Tables) -> DataFrame:
    return segments.with_segment_notes(_segmented(t).select("customer_id", "segment"))


# lifetime value


@query
def clv_summary(t: Tables) -> DataFrame:
    return settled(single(clv.repeat_summary(t.purchases), "monetary_value"), "monetary_value")


def _purchase_loglik(t: Tables, g: clv.PurchaseModel) -> DataFrame:
    histories = clv.repeat_summary(t.purchases).groupBy("x", "tx", "t").agg(F.count(F.lit(1)).alias("n"))
    points = np.array([[g.r, g.alpha, g.a, g.b]])
    sums = clv.log_likelihood_sums(histories, ["x", "tx", "t"], clv.purchase_log_likelihood, points)
    return sums.select(F.round(F.col("log_likelihood") / F.col("weight"), 6).alias("mean_log_likelihood"))


def _value_loglik(t: Tables, g: clv.ValueModel) -> DataFrame:
    repeat = clv.repeat_summary(t.purchases).filter("x > 0").withColumn("n", F.lit(1))
    sums = clv.log_likelihood_sums(
        repeat, ["x", "monetary_value"], clv.value_log_likelihood, np.array([[g.p, g.q, g.v]])
    )
    return sums.select(F.round(F.col("log_likelihood") / F.col("weight"), 6).alias("mean_log_likelihood"))


@query
def bgnbd_loglik(t: Tables) -> DataFrame:
    return _purchase_loglik(t, GIVEN_PURCHASE)


@query
def gammagamma_loglik(t: Tables) -> DataFrame:
    return _value_loglik(t, GIVEN_VALUE)


def _gradient(histories: DataFrame, columns: list[str], derivatives, names: list[str], point: list[float]) -> DataFrame:
    _, gradient, _ = clv.mean_derivatives(histories, columns, derivatives, np.array([point]))
    rows = [(name, round(float(g), 5)) for name, g in zip(names, gradient[0])]
    return histories.sparkSession.createDataFrame(rows, "parameter string, slope double")


@query
def bgnbd_gradient(t: Tables) -> DataFrame:
    g, histories = GIVEN_PURCHASE, clv.repeat_summary(t.purchases).withColumn("n", F.lit(1))
    return _gradient(histories, ["x", "tx", "t"], clv.purchase_derivatives, ["r", "alpha", "a", "b"], [g.r, g.alpha, g.a, g.b])


@query
def gammagamma_gradient(t: Tables) -> DataFrame:
    g, repeat = GIVEN_VALUE, clv.repeat_summary(t.purchases).filter("x > 0").withColumn("n", F.lit(1))
    return _gradient(repeat, ["x", "monetary_value"], clv.value_derivatives, ["p", "q", "v"], [g.p, g.q, g.v])


@query
def bgnbd_fit(t: Tables) -> DataFrame:
    m = clv.fit_purchase_model(durable(clv.repeat_summary(t.purchases), "summary"))
    return t.spark.createDataFrame([(m.r, m.alpha, m.a, m.b)], "r double, alpha double, a double, b double")


@query
def gammagamma_fit(t: Tables) -> DataFrame:
    m = clv.fit_value_model(durable(clv.repeat_summary(t.purchases), "summary"))
    return t.spark.createDataFrame([(m.p, m.q, m.v)], "p double, q double, v double")


@query
def expected_purchases(t: Tables) -> DataFrame:
    return settled(_valued(t).select("customer_id", "expected_purchases"))


@query
def predicted_clv(t: Tables) -> DataFrame:
    return settled(_valued(t).select("customer_id", "predicted_clv"))


@query
def customer_360(t: Tables) -> DataFrame:
    model = segments.fit_segments(t.customers)
    summary = durable(clv.repeat_summary(t.purchases), "summary")
    valued = clv.add_lifetime_value(summary, clv.fit_purchase_model(summary), clv.fit_value_model(summary))
    return settled(clv.attach_lifetime_value(segments.score_segments(t.customers, model), valued))


@query
def score_clv_inputs(t: Tables) -> DataFrame:
    scored = single(clv.score_lifetime_value(t.customers, GIVEN_PURCHASE, GIVEN_VALUE), "monetary_value")
    return settled(
        scored.select("customer_id", "x", "tx", "t", "monetary_value", "expected_purchases", "predicted_clv"),
        "monetary_value",
    )


def _low_dropout(t: Tables) -> DataFrame:
    """Each customer as known, and the same one as if only the first purchase were known."""
    known = clv.repeat_summary(t.purchases)
    new = known.select(F.concat(F.lit("new "), "customer_id").alias("who"), *[F.lit(0).cast(known.schema[c].dataType).alias(c) for c in ("x", "tx")], "t", "monetary_value")
    both = known.select(F.col("customer_id").cast("string").alias("who"), "x", "tx", "t", "monetary_value").unionByName(new)
    return clv.add_lifetime_value(both, LOW_DROPOUT, GIVEN_VALUE)


@query
def expected_purchases_low_dropout(t: Tables) -> DataFrame:
    return settled(_low_dropout(t).select("who", "expected_purchases"))


@query
def predicted_clv_low_dropout(t: Tables) -> DataFrame:
    # the SQL integrates, which agrees to eight digits
    return _low_dropout(t).filter("x > 0").select("who", F.round("predicted_clv", 4).alias("predicted_clv"))


@query
def bgnbd_loglik_low_dropout(t: Tables) -> DataFrame:
    return _purchase_loglik(t, LOW_DROPOUT)


@query
def gammagamma_loglik_low_spread(t: Tables) -> DataFrame:
    return _value_loglik(t, LOW_SPREAD)


# recommendations


@query
def popular_items(t: Tables) -> DataFrame:
    return interactions.popular_items(t.purchases, POPULAR_LINES)


@query
def interactions_binary(t: Tables) -> DataFrame:
    return interactions.binary_interactions(interactions.stored_counts(t.purchases))


@query
def interactions_binary_popular(t: Tables) -> DataFrame:
    return interactions.binary_interactions(interactions.stored_counts(t.purchases), POPULAR_LINES)


@query
def item_cosine(t: Tables) -> DataFrame:
    return settled(item_cf.item_cosine(interactions.stored_counts(t.purchases)))


@query
def item_cf_topn(t: Tables) -> DataFrame:
    return settled(item_cf.similar_items(interactions.stored_counts(t.purchases)))


@query
def item_cosine_weighted(t: Tables) -> DataFrame:
    return settled(item_cf.similar_items_weighted(interactions.stored_counts(t.cleaned)))


@query
def bestsellers(t: Tables) -> DataFrame:
    return interactions.bestsellers(t.purchases)


@query
def catalog(t: Tables) -> DataFrame:
    return interactions.catalog(t.purchases)


@query
def catalog_listed(t: Tables) -> DataFrame:
    return interactions.listed_items(item_cf.similar_items(interactions.stored_counts(t.purchases)))


@query
def rules_lookup_fallback(t: Tables) -> DataFrame:
    asked = t.source("part").select(F.col("p_name").alias("description")).unionByName(interactions.catalog(t.cleaned)).distinct()
    rules = basket.top_rules(basket.association_rules(interactions.stored_counts(t.purchases, "invoice_no")))
    values = ["item", "lift", "confidence"]
    return settled(interactions.lookup_or_fallback(asked, rules, basket.rules_fallback(t.purchases), "description", values))


@query
def basket_pairs(t: Tables) -> DataFrame:
    return basket.basket_pairs(interactions.stored_counts(t.purchases, "invoice_no"))


@query
def association_rules(t: Tables) -> DataFrame:
    return settled(basket.association_rules(interactions.stored_counts(t.purchases, "invoice_no")))


@query
def rules_topn(t: Tables) -> DataFrame:
    rules = basket.association_rules(interactions.stored_counts(t.purchases, "invoice_no"))
    return settled(basket.top_rules(rules))


@query
def rules_fallback(t: Tables) -> DataFrame:
    return basket.rules_fallback(t.purchases)


@query
def rules_global_top(t: Tables) -> DataFrame:
    rules = basket.association_rules(interactions.stored_counts(t.purchases, "invoice_no"))
    return settled(basket.strongest_rules(rules))


@query
def rules_for_target(t: Tables) -> DataFrame:
    counts = interactions.stored_counts(t.cleaned, "invoice_no")
    return settled(basket.rules_for_targets(t.cleaned, counts, min_support=TARGET_SUPPORT))


def _asked_products(lines: DataFrame) -> DataFrame:
    """Descriptions whose number, the first 32 bits of the MD5, is divisible by 50; product codes aren't all numbers."""
    number = F.conv(F.substring(F.md5("description"), 1, 8), 16, 10).cast("bigint")
    return lines.filter(number % 50 == 0).select("description").distinct()


@query
def rules_for_asked(t: Tables) -> DataFrame:
    """Rules of single products, from the invoices that hold one of them."""
    counts = interactions.stored_counts(t.cleaned, "invoice_no")
    return settled(basket.rules_for_targets(t.cleaned, counts, _asked_products(t.cleaned), TARGET_SUPPORT))


@query
def similar_items_weighted_for(t: Tables) -> DataFrame:
    """Items similar to single products, from the customers who bought one of them."""
    return settled(item_cf.similar_items_weighted(interactions.stored_counts(t.cleaned), targets=_asked_products(t.cleaned)))


@query
def user_neighbors(t: Tables) -> DataFrame:
    return settled(user_cf.nearest_customers(interactions.stored_counts(t.purchases)))


@query
def user_cf_recs(t: Tables) -> DataFrame:
    counts = interactions.stored_counts(t.purchases)
    return user_cf.recommend_from_neighbors(counts, user_cf.nearest_customers(counts))


@query
def user_cf_fallback(t: Tables) -> DataFrame:
    counts = interactions.stored_counts(t.purchases)
    recs = user_cf.recommend_from_neighbors(counts, user_cf.nearest_customers(counts))
    asked = t.source("customer").select(F.col("c_custkey").alias("customer_id"))
    return interactions.lookup_or_fallback(
        asked, recs, user_cf.customer_fallback(t.purchases), "customer_id", ["item", "score"]
    )


def _asking(t: Tables) -> DataFrame:
    """The customers that ask: every 50th of the customer table."""
    return t.source("customer").filter("c_custkey % 50 = 0").select(F.col("c_custkey").alias("customer_id"))


@query
def user_neighbors_for(t: Tables) -> DataFrame:
    return settled(user_cf.nearest_customers(interactions.stored_counts(t.purchases), targets=_asking(t)))


@query
def user_cf_recs_for(t: Tables) -> DataFrame:
    counts = interactions.stored_counts(t.purchases)
    return user_cf.recommend_from_neighbors(counts, user_cf.nearest_customers(counts, targets=_asking(t)))


@query
def content_similar_for(t: Tables) -> DataFrame:
    return content.similar_texts(content.description_tfidf(t.purchases), "description", targets=_asked_products(t.purchases))


@query
def tfidf_weights(t: Tables) -> DataFrame:
    return settled(content.description_tfidf(t.purchases))


@query
def tfidf_documents(t: Tables) -> DataFrame:
    return settled(content.tfidf(t.source("documents").select("doc_id", "text"), "doc_id", "text"))


@query
def content_similar(t: Tables) -> DataFrame:
    return content.similar_texts(content.description_tfidf(t.purchases), "description")


@query
def content_similar_documents(t: Tables) -> DataFrame:
    weights = content.tfidf(t.source("documents").select("doc_id", "text"), "doc_id", "text", numbered=True)
    return content.similar_texts(weights, "doc_id")


@query
def customer_list(t: Tables) -> DataFrame:
    return interactions.customer_list(t.cleaned)


# reports


@query
def top_countries_lines(t: Tables) -> DataFrame:
    return eda.top_countries_by_lines(t.cleaned)


@query
def top_countries_revenue(t: Tables) -> DataFrame:
    return settled(eda.top_countries_by_revenue(t.cleaned))


@query
def aov_by_country(t: Tables) -> DataFrame:
    return settled(eda.average_order_value_by_country(t.cleaned))


@query
def top_products_qty(t: Tables) -> DataFrame:
    return eda.top_products_by_quantity(t.cleaned)


@query
def top_products_revenue(t: Tables) -> DataFrame:
    return settled(eda.top_products_by_revenue(t.cleaned))


@query
def hist_unit_price(t: Tables) -> DataFrame:
    return settled(eda.unit_price_histogram(t.cleaned))


@query
def hist_line_value(t: Tables) -> DataFrame:
    return settled(eda.line_value_histogram(t.cleaned))


@query
def hist_line_value_clipped(t: Tables) -> DataFrame:
    return settled(eda.line_value_histogram(t.cleaned, limit=100.0))


@query
def hist_quantity(t: Tables) -> DataFrame:
    return settled(eda.quantity_histogram(t.cleaned))


@query
def hist_rfm(t: Tables) -> DataFrame:
    return settled(eda.rfm_histograms(t.customers))


@query
def kde_rfm(t: Tables) -> DataFrame:
    return settled(kernel_density(t.customers, rfm.RFM))


@query
def kde_rfm_log(t: Tables) -> DataFrame:
    logs = t.customers.select(*[F.log1p(c).alias(f"log_{c}") for c in rfm.RFM])
    return settled(kernel_density(logs, [f"log_{c}" for c in rfm.RFM]))


@query
def kde_unit_price(t: Tables) -> DataFrame:
    return settled(kernel_density(t.cleaned.filter(F.col("unit_price") <= 15), ["unit_price"]))


@query
def monthly_revenue(t: Tables) -> DataFrame:
    return settled(eda.monthly_revenue(t.cleaned))


@query
def monthly_revenue_all_lines(t: Tables) -> DataFrame:
    return settled(eda.monthly_revenue(t.cleaned, positive_only=False))


@query
def monthly_orders(t: Tables) -> DataFrame:
    return eda.monthly_orders(t.cleaned)


@query
def monthly_orders_all_lines(t: Tables) -> DataFrame:
    return eda.monthly_orders(t.cleaned, positive_only=False)


@query
def orders_by_weekday(t: Tables) -> DataFrame:
    return eda.orders_by_weekday(t.cleaned)


@query
def orders_by_hour(t: Tables) -> DataFrame:
    return eda.orders_by_hour(t.cleaned)


@query
def scatter_price_qty(t: Tables) -> DataFrame:
    return eda.price_quantity_sample(t.cleaned)


@query
def cohort_acquisition(t: Tables) -> DataFrame:
    return eda.new_customers_by_month(t.cleaned)


@query
def first_purchase_window(t: Tables) -> DataFrame:
    lines = eda.with_first_purchase_month(t.cleaned)
    return lines.select("customer_id", "invoice_no", "stock_code", "quantity", "first_purchase_month")


@query
def rfm_correlation(t: Tables) -> DataFrame:
    return settled(eda.rfm_correlation(rfm.rfm_base(t.cleaned, positive_only=False)))


@query
def rfm_correlation_capped(t: Tables) -> DataFrame:
    return settled(eda.rfm_correlation(t.customers))


# hypothesis tests


@query
def welch_ttest(t: Tables) -> DataFrame:
    return settled(hypothesis.welch_ttest(t.purchases, F.col("total_amount"), F.col("country") == UK))


@query
def welch_ttest_cleaned(t: Tables) -> DataFrame:
    return settled(hypothesis.welch_ttest(t.cleaned, F.col("total_amount"), F.col("country") == UK))


@query
def pearson_test(t: Tables) -> DataFrame:
    return settled(hypothesis.pearson_test(t.purchases, "quantity", "unit_price"))


@query
def pearson_test_sampled(t: Tables) -> DataFrame:
    columns = [*eda.SAMPLE_KEY, "unit_price"]
    drawn = sample_exact(t.purchases.select(*columns), 10_000, eda.SAMPLE_KEY, ties=["unit_price"])
    return settled(hypothesis.pearson_test(drawn, "quantity", "unit_price"))


@query
def anova_weekday(t: Tables) -> DataFrame:
    return settled(hypothesis.anova(t.purchases, "total_amount", F.date_format("invoice_date", "EEEE")))


@query
def anova_weekday_cleaned(t: Tables) -> DataFrame:
    return settled(hypothesis.anova(t.cleaned, "total_amount", F.date_format("invoice_date", "EEEE")))
