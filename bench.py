"""Wall-clock of the headline queries, one JSON line.  BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemart.plans.queries import QUERIES
from tidemart.session import build_session, release_scratch

HEADLINE = [
    "dedup_latest", "sessionize_30", "sessionize_720", "scd2_users", "scd2_products", "fact_orders_bulk", "daily_sales_bulk",
    "daily_funnel", "abandoned_carts", "user_order_metrics_bulk", "user_360", "pit_orders_users", "pit_lines_products",
    "enrich_cart_events", "doc_text", "embed_documents", "knn_topk", "knn_postfiltered", "popularity_score", "hybrid_rank",
    "quality_events", "upsert_all", "contract_check", "rescued_fields", "late_split", "medallion_refresh", "stream_upsert",
    "backfill_window",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - started
        release_scratch(spark)
        return took

    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(name)  # warm-up
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
