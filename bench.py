"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query runs once to warm up, then BENCH_RUNS timed runs (median); every
run fully materialises the result through a ``noop`` write, so nothing is
collected to the driver.  Shuffle-write and spill bytes per query come from
Spark's event log, written to a fresh scratch folder (mean over timed runs).
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time
from collections import defaultdict

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from shelflens import registry  # noqa: E402
from shelflens.session import get_session  # noqa: E402

HEADLINE = ["q_inventory_report", "q_describe_metrics", "q_profile_missing", "q_kmeans", "q_dbscan"]


def read_event_log(log_dir: str) -> dict[str, dict[str, int]]:
    """Per job group: shuffle bytes, spill bytes, executor run/CPU time, tasks."""
    stage_group: dict[int, str] = {}
    totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(paths):
        with open(path, encoding="utf-8") as f:
            for line in f:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not group or not m:
                        continue
                    t = totals[group]
                    t["shuffle_write_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    t["shuffle_read_bytes"] += sum((m.get("Shuffle Read Metrics") or {}).get(k, 0)
                                                   for k in ("Remote Bytes Read", "Local Bytes Read"))
                    t["memory_spill_bytes"] += m.get("Memory Bytes Spilled", 0)
                    t["disk_spill_bytes"] += m.get("Disk Bytes Spilled", 0)
                    t["executor_run_ms"] += m.get("Executor Run Time", 0)
                    t["executor_cpu_ms"] += m.get("Executor CPU Time", 0) // 1_000_000
                    t["tasks"] += 1
    return totals


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    scratch = tempfile.mkdtemp(prefix="shelflens-bench-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    memory = os.environ.get("BENCH_DRIVER_MEMORY", "16g")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                        extra={"spark.driver.memory": memory,
                               "spark.local.dir": os.path.join(scratch, "local"),
                               "spark.eventLog.enabled": "true",
                               "spark.eventLog.compress": "false",
                               "spark.eventLog.rolling.enabled": "false",
                               "spark.eventLog.dir": log_dir})
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    qs = registry.queries()
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            fn = qs[name]
            sc.setJobGroup(f"warm:{name}", name)
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples = []
            for i in range(runs):
                sc.setJobGroup(f"run:{name}:{i}", name)
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            timings[name] = round(statistics.median(samples), 3)
            sc.setJobGroup(f"count:{name}", name)
            rows[name] = fn(spark, sf_dir).count()
        except Exception as e:  # noqa: BLE001 - report and keep measuring the others
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    spark.stop()
    per_group = read_event_log(log_dir)
    io: dict[str, dict[str, int]] = {}
    for name in names:
        agg: dict[str, int] = defaultdict(int)
        for i in range(runs):
            for k, v in per_group.get(f"run:{name}:{i}", {}).items():
                agg[k] += v
        io[name] = {k: int(v / max(runs, 1)) for k, v in agg.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "median_query_seconds_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "rows": rows,
        "io": io,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "driver_memory": memory,
        "runs": runs,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
