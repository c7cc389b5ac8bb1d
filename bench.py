"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the local cores (default 8),
BENCH_QUERIES a comma-separated subset.
"""

from __future__ import annotations

import json
import os
import time

from freshet.catalog import QUERIES
from freshet.catalog.base import earlier, events
from freshet.session import local_session

HEADLINE = (
    "incremental_enrich",
    "ingest_first_run",
    "ingest_second_run",
    "channel_stats_flatten",
    "video_details_flatten",
    "search_all_pages",
    "incremental_filter",
    "anti_seen",
    "enrich_channel",
    "distinct_ids",
    "cap_per_channel",
    "request_batches",
    "run_audit",
    "state_upsert",
    "state_import",
    "silver_latest",
    "gold_by_channel",
    "gold_by_category",
    "channel_growth",
    "channel_name_history",
    "dq_report",
    "numeric_coerce",
    "iso_duration_seconds",
    "csv_roundtrip",
    "lake_partitioned_write",
    "stream_dedup",
)


def seconds(spark, sf_dir: str, name: str) -> float:
    """Building the query (some write and read back tables) plus producing every row of it."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cpus, "bench", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("OFF")
    seconds(spark, sf_dir, "incremental_enrich")  # starts the JVM's compiler, not measured
    times = {name: min(seconds(spark, sf_dir, name) for _ in range(2)) for name in names}
    # What the first run finds: the events before the cut-off.
    videos = earlier(events(spark, sf_dir)).count()
    result = {
        "metric": "total wall clock of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "first_run_videos": videos,
    }
    if times.get("ingest_first_run"):
        result["first_run_videos_per_sec"] = round(videos / times["ingest_first_run"], 1)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
