"""Benchmark the headline queries; prints ONE JSON line.

Env: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_REPEAT`` (default 3; the median is reported, for batch queries and
streams alike). Each batch query is materialized in full through the
``noop`` sink. Each stream run lands its input in a fresh folder first
(untimed), then drains it with ``availableNow`` from a fresh checkpoint; the
figure is the drain time and one read of the result, and readings/s is
reported beside it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

import monitor_queries as C  # noqa: E402
from wardwatch.session import build_session  # noqa: E402
from wardwatch.streaming import jobs  # noqa: E402

BATCH = ("stg_patient_vitals", "latest_per_patient", "ward_hourly", "patient_health_summary",
         "triage_ranked", "dq_report", "ingest_decode", "mon_abnormal", "mart_upsert")


def run_batch(spark, key: str, sf_dir: str) -> float:
    t = time.perf_counter()
    C.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def run_stream(spark, key: str, sf_dir: str) -> tuple[float, int]:
    work, src = C._landed(spark, sf_dir, f"bench-{key}")
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    t = time.perf_counter()
    stamp = F.col(C.SOURCE_STAMP)
    if key == "stream_ward_hourly":
        q = jobs.start_ward_hourly(src, f"{work}/out", f"{work}/checkpoint", stamp=stamp)
    elif key == "stream_latest":
        q = jobs.start_latest(src, f"{work}/mart", f"{work}/checkpoint", stamp=stamp)
    else:
        raise KeyError(key)
    jobs.run_to_end(q)
    (jobs.read_ward_hourly(spark, f"{work}/out") if key == "stream_ward_hourly" else jobs.latest_table(spark, f"{work}/mart").read()
     ).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t, n


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", "wardwatch-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    run_batch(spark, "stg_patient_vitals", sf_dir)          # warm-up: JIT, codegen caches
    queries: dict[str, float] = {}
    for key in BATCH:
        queries[key] = round(statistics.median(run_batch(spark, key, sf_dir) for _ in range(repeat)), 3)
    streams: dict[str, float] = {}
    for key in ("stream_ward_hourly", "stream_latest"):
        runs = [run_stream(spark, key, sf_dir) for _ in range(repeat)]
        sec = statistics.median(r[0] for r in runs)
        n = runs[0][1]
        queries[key] = round(sec, 3)
        streams[f"{key}_readings_per_sec"] = round(n / sec, 1)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "total_sec", "value": round(sum(queries.values()), 3), "unit": "sec",
        "queries": queries, "streams": streams, "sf": sf,
        "cores": cpus, "driver_memory": "16g", "spark": spark.version, "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
