"""Headline-query benchmark.

``local[$BENCH_CPUS]`` and prints one JSON line. Each query is executed to
completion with the ``noop`` sink (whole plan, no driver collect), twice:
``cold`` is the first run in the session, ``queries`` the second (warm).
``value`` is the sum of the warm times. ``shuffle_bytes`` (warm run) comes
from Spark's event log, written to a fresh scratch folder.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from fieldkit.plans import catalog  # noqa: E402
from fieldkit.session import get_spark  # noqa: E402

HEADLINE = ["population_by_province", "mean_household_size", "word_count_ws", "trip_clusters", "trips",
            "od_flows", "tower_hour_profile", "html_links", "rf_predictions"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def shuffle_bytes_by_group(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job group, summed over task-end events."""
    stage_group: dict[int, str] = {}
    out: dict[str, int] = {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if not os.path.isfile(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        if group:
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if group:
                        out[group] = out.get(group, 0) + int(m.get("Shuffle Bytes Written", 0))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    log_dir = tempfile.mkdtemp(prefix="fieldkit-bench-events-")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus), app_name="fieldkit-bench",
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                             "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    q = catalog.queries()
    run(q["row_count"](spark, sf_dir))  # JVM / reader warm-up, not timed
    cold, warm = {}, {}
    for name in names:
        sc.setJobGroup(f"cold:{name}", name)
        t0 = time.perf_counter()
        run(q[name](spark, sf_dir))
        cold[name] = round(time.perf_counter() - t0, 3)
        sc.setJobGroup(f"warm:{name}", name)
        t0 = time.perf_counter()
        run(q[name](spark, sf_dir))
        warm[name] = round(time.perf_counter() - t0, 3)
    version = spark.version
    spark.stop()
    shuffled = shuffle_bytes_by_group(log_dir)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total_warm", "value": round(sum(warm.values()), 3), "unit": "sec",
           "queries": warm, "cold": cold,
           "shuffle_bytes": {n: shuffled.get(f"warm:{n}", 0) for n in names},
           "sf": float(m.group(1)) if m else sf_dir, "cores": int(cpus), "spark": version}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
