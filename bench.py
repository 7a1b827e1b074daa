"""Run the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line.

Each query is fully computed with the ``noop`` sink (every row produced, nothing collected to the
driver).  The first query also pays for JVM warm-up, so one untimed warm-up run precedes the timings.
With ``$BENCH_EVENTS`` (an empty folder for Spark's event log) the line also gives, for each query, the MB that
its shuffles wrote and the MB that it spilled.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronoframe.plans.catalog import load_all  # noqa: E402
from chronoframe.session import drop_stages, get_session  # noqa: E402

# SURVEY §6 bench set: T01, J02+W02, A09, R05, A12, E04, F17, M08 (+ the 6-hour T01 flagship)
HEADLINE = ["ts_samples_hourly", "ts_samples", "ffill", "resample_mean", "kfold", "corr_matrix",
            "ens_rank", "knn", "roc_auc"]


def moved(folder: str, spans: dict[str, tuple[float, float]]) -> dict[str, list[float]]:
    """``[shuffle MB, spill MB]`` of the tasks that began inside each query's time."""
    out = {n: [0.0, 0.0] for n in spans}
    for path in Path(folder).rglob("*"):
        if not path.is_file() or path.name.startswith("."):
            continue
        for line in path.open(errors="replace"):
            if '"SparkListenerTaskEnd"' not in line:
                continue
            e = json.loads(line)
            at, m = e["Task Info"]["Launch Time"] / 1000, e.get("Task Metrics") or {}
            for n, (a, b) in spans.items():
                if a <= at <= b:
                    out[n][0] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 1e6
                    out[n][1] += m.get("Disk Bytes Spilled", 0) / 1e6
    return {n: [round(x, 2) for x in v] for n, v in out.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    events = os.environ.get("BENCH_EVENTS")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}", "spark.eventLog.compress": "false"} if events else {}
    spark = get_session(f"local[{cpus}]", int(cpus) * 2, extra=extra)
    cat = load_all()
    names = [n for n in HEADLINE if n in cat]
    cat[names[0]].build(spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
    times: dict[str, float] = {}
    spans: dict[str, tuple[float, float]] = {}
    for n in names:
        began, t0 = time.time(), time.perf_counter()
        cat[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
        spans[n] = (began, time.time())
        drop_stages(spark)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}
    if events:
        line["shuffle_mb_spill_mb"] = moved(events, spans)
    print(json.dumps(line))


if __name__ == "__main__":
    main()
