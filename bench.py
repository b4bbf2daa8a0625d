"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list
or "all"). Every query runs over whole tables into a sink that discards the rows; "queries" holds
the warm time, "cold" the first run.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "mart_daily_revenue",
    "dedup_latest_2key",
    "dim_customers",
    "mart_repeat_purchase",
    "mart_delivery_delay",
    "order_dominant_item",
    "seller_customer_distance",
    "first_order_features",
    "expanding_prior_rate",
    "seller_ewma_prior",
    "route_prior_shrunk",
    "seller_lifetime_stats",
    "delivery_features",
    "risk_tiers",
    "kpi_overview",
    "revenue_by_category",
    "reviews_weekly",
    "price_quantiles",
    "category_top15",
    "incr_daily_revenue_merge",
    "incr_equals_full",
    "stream_6h_counts",
    "replay_items",
    "replay_growth",
    "dq_relationships",
    "ml_customer_segments",
    "delivery_features_open",
    "review_features",
    "ml_elbow",
    "ml_delivery_risk",
    "ml_review_risk",
    "ml_incremental_value",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from marlake.queries import QUERIES
    from marlake.session import drop_scratch, local_session

    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, "marlake-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("status_share")
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(run(name), 3)
        warm[name] = round(run(name), 3)
        print(f"{name:32s} {cold[name]:8.3f} {warm[name]:8.3f}", file=sys.stderr, flush=True)
    drop_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(folder.rstrip("/")).replace("sf", ""),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
