"""Times the headline queries and prints one JSON line.

Each query is run once to warm up and then BENCH_RUNS times; the median counts. A run builds the
query, with all tables it writes on the way, and consumes every row of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = (
    "hourly_upsert",
    "daily_summary",
    "daily_upsert_multi",
    "partitioned_upsert",
    "full_refresh",
    "duplicate_keys",
    "check_report",
    "missing_dates",
    "pending_ids",
    "request_flags",
    "request_params",
    "topk_with_includes",
    "one_big_table",
    "price_change",
    "quarterly_rate",
    "hour_profile",
    "latest_snapshot",
    "fuzzy_names",
    "html_links",
    "normalised_text",
    "union_by_name_lineage",
    "csv_export_roundtrip",
    "latest_partition",
    "file_ingest_stream",
    "incremental_job",
    "marts_job",
    "rebuild_job",
    "staged_crawl_job",
    "batch_load_job",
    "weather_job",
    "document_archive",
    "crawl_fetch",
    "bucketed_upsert",
    "marts_incremental",
    "partial_hours_stream",
    "queued_crawl",
    "snapshot_history",
    "pending_ids_bitmap",
    "token_set_names",
)


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, **{"spark.driver.memory": "8g"})
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
