"""Benchmark: headline queries at one scale factor into the discarding sink.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries"
(seconds per query), "sf"}. Each query runs end to end (read parquet ->
operators -> ``noop`` sink), after an untimed warm-up on sf0.001 (JIT, codegen, Python workers).

The events table at hand is one row group, which no reader can split. So it is copied, untimed, into as many
files as there are CPUs, as a cluster's table would have; queries read the copy.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sliding_count_sum",      # incremental sliding window (A1)
    "sliding_full_buffer",    # whole-buffer window (A2)
    "decode_drop_malformed",  # JSON decode with drop rules (P1)
    "location_enrich",        # broadcast enrichment (E1)
    "location_enrich_async",  # lookup client with TTL cache (E2)
    "ttl_cache_hits",         # event-time TTL fold (E3)
    "sorted_stream",          # per-sensor event-time order (T1/T2)
    "ema_corrected",          # correction + moving average (P4, T3)
    "sort_lag_stats",         # lag summary (M2)
    "sliding_stream_final",   # watermarked streaming windows (W2, W7)
    "ema_stream_final",       # streaming sort + EMA state (T1-T3)
    "user_aggregate_windows",  # user aggregate over windows (U3)
    "buffer_fold_split",      # ordered user fold, hot key (U4)
    "session_gap_process",    # keyed process function with timers (U5)
]


TABLES = ("events", "nation", "region")


def split_tables(spark, sf_dir: str, files: int) -> str:
    """A folder with the tables that the headline queries read, events in several files."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for name in TABLES:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "events":
            df = df.repartitionByRange(files, "event_id").sortWithinPartitions("event_id")
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from sensorium.plans.catalog import QUERIES
    from sensorium.session import local_session
    spark = local_session(cpus)
    # untimed warm-up on the smallest tables: JIT, codegen and Python workers
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in ("sliding_count_sum", "ema_corrected", "location_enrich_async"):
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    data = split_tables(spark, sf_dir, int(cpus))
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
