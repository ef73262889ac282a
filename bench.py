"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) holds the tables, BENCH_CPUS (default 8)
is the number of local threads. Each query runs once to warm up and then BENCH_RUNS
times (default 3); the median counts. Results are written to the no-op sink, so
every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tideline.sample import catalog
from tideline.session import local_session

HEADLINE = [
    "daily_disable_rate_legacy",
    "daily_unique_engagement_legacy",
    "monthly_unique_engagement_legacy",
    "daily_spoc_fill_rate_legacy",
    "engagement_by_tile_position_legacy",
    "engagement_by_tile_position_locale_legacy",
    "daily_disable_rate_nested",
    "daily_unique_engagement_nested",
    "daily_spoc_fill_rate_nested",
    "engagement_by_tile_position_nested",
    "engagement_by_tile_position_locale_nested",
    "trailing_engagement_nested_approx",
    "trailing_engagement_activity_stream",
    "aggregate_engagement",
    "backend_events_export",
    "publisher_features",
    "user_impressions",
    "revenue_key_replace",
    "content_score",
    "article_text",
    "candidate_set_json",
    "legacy_curated_feeds",
    "user_delta_payloads",
    "purge_two_keys",
    "purge_json_key",
    "range_replace",
    "upsert_offsets",
    "compact_latest",
    "tag_batches",
    "feature_records",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(taken[1:]), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
