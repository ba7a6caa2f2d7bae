"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) is the table folder, ``BENCH_CPUS`` (default 8) the
number of local cores, ``BENCH_RUNS`` (default 3) the runs per query after one warm-up; the median is
reported. Every result is computed in full and discarded by the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adpulse import configure  # noqa: E402
from adpulse.plans import registry  # noqa: E402

HEADLINE = (
    "ssp_validate_rows", "dsp_validate_rows",
    "ssp_tumbling_1min", "ssp_sliding_5min", "ssp_tumbling_1hour", "ssp_campaign_rollup",
    "dsp_tumbling_1min", "dsp_sliding_5min", "dsp_campaign_rollup",
    "ssp_reject_stats", "ssp_dead_letters",
    "ssp_archive_rows", "dsp_archive_rows", "ssp_archive_round_trip",
    "json_decode_ssp", "json_decode_dsp", "json_decode_mixed", "json_encode_metrics",
    "event_fingerprint", "dedup_fingerprint", "legacy_mapping_join",
    "stream_equals_batch_ssp", "stream_sliding_ssp", "stream_archive_ssp",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_ONLY")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("adpulse-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    queries = registry()
    names = [n for n in HEADLINE if not only or n in only.split(",")]
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times[1:]), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "events": events, "cpus": int(cpus),
        "events_per_second": {n: round(events / s) for n, s in seconds.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
