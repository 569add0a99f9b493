"""Time the headline queries; prints one JSON line.

Each query runs once to warm up, then up to three times within a time limit; its
time is the median.  Rows are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import local_session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "report_age",
    "report_placement",
    "report_age_conv",
    "report_ad_conv",
    "report_campaign",
    "report_ads",
    "report_geo",
    "report_paid_organic",
    "backfill_age",
    "backfill_keyword",
    "typed_projection",
    "geo_lookup_inner5",
    "carry_forward_absent",
    "merge_union_distinct",
    "consolidate_criteria_performance",
    "consolidate_criteria_conv",
    "flatten_records",
    "decode_enums",
    "stringify_raw",
    "missing_dates_by_chunk",
    "cast_loss_counts",
    "deactivated_accounts_by_feed",
    "dynamic_partition_overwrite",
    "self_read_overwrite",
]
RUNS = 3
SECONDS_PER_QUERY = 12.0


def run(query, spark, folder: str) -> float:
    began = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def median_time(query, spark, folder: str) -> float:
    run(query, spark, folder)
    times: list[float] = []
    while len(times) < RUNS and sum(times) < SECONDS_PER_QUERY:
        times.append(run(query, spark, folder))
    return statistics.median(times)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "16g")
    times = {name: round(median_time(QUERIES[name], spark, folder), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
