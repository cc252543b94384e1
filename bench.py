"""Wall time of the headline queries; prints one JSON line.

Each result is computed whole into Spark's no-op sink: once to warm up, then up
to three times (fewer when a run is long); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillroll.plans.queries import QUERIES  # noqa: E402
from tillroll.session import local_session  # noqa: E402

HEADLINE = [
    "clean_retail", "clean_audit", "profile_columns", "rfm_capped", "return_ratio", "kmeans_segments",
    "segment_summary", "clv_summary", "bgnbd_fit", "predicted_clv", "item_cf_topn", "item_cosine_weighted",
    "association_rules", "rules_for_target", "user_neighbors", "user_cf_recs", "content_similar", "tfidf_documents",
    "top_countries_revenue", "aov_by_country", "monthly_orders", "hist_unit_price", "cohort_acquisition",
    "first_purchase_window", "welch_ttest", "anova_weekday",
]
BUDGET = 15.0  # seconds of timed runs per query


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "16g")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    took = {}
    for name in os.environ.get("BENCH_QUERIES", "").split() or HEADLINE:
        run(name)
        times = [run(name)]
        while len(times) < 3 and sum(times) + times[-1] < BUDGET:
            times.append(run(name))
        took[name] = round(statistics.median(times), 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
