"""Measure how a hot key spreads over tasks: window vs skew-safe scan.

Builds a hot key from ``lineitem`` (one key value holds a third of the rows, the
rest are spread), ranks within the key with ``strategy="window"`` and with
``strategy="scan"``, and reads the per-task shuffle records from Spark's event
log (written to a fresh folder given on the command line; the UI stays off).
For every stage that reads a shuffle it prints the largest and median records
per task — the straggler measure.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import time


def stage_records(log_dir: str) -> dict[str, list[dict]]:
    """job group -> list of {stage, tasks, max_records, median_records}."""
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(f) and os.path.basename(f).startswith(("events_", "local-", "app-"))]
    stage_group, per_stage = {}, {}
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = grp
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    rec = m.get("Total Records Read", 0)
                    per_stage.setdefault(ev["Stage ID"], []).append(rec)
    out: dict[str, list[dict]] = {}
    for sid, recs in sorted(per_stage.items()):
        if not any(recs):
            continue
        grp = stage_group.get(sid)
        out.setdefault(grp, []).append({"stage": sid, "tasks": len(recs), "max_records": max(recs),
                                        "median_records": statistics.median(recs)})
    return out


def main(log_dir: str, sf_dir: str = "/root/testdata/sf0.1") -> None:
    sys.path.insert(0, os.getcwd())
    from pyspark.sql import functions as F

    from sparkdeck.operators.ordered import rank_within
    from sparkdeck.session import get_session

    spark = get_session("local[8]", shuffle_partitions=16,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
                               "spark.eventLog.compress": "false"})
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice")
    # a third of the rows share key 0; the others keep their order key
    hot = li.withColumn("k", F.when(F.col("l_linenumber") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))
    n = hot.count()
    timings = {}
    for strategy in ("window", "scan"):
        spark.sparkContext.setJobGroup(strategy, strategy)
        t0 = time.perf_counter()
        kwargs = {"num_partitions": 16} if strategy == "scan" else {}
        rank_within(hot, ["k"], [("l_extendedprice", False)], name="rk", strategy=strategy, **kwargs) \
            .write.format("noop").mode("overwrite").save()
        timings[strategy] = round(time.perf_counter() - t0, 2)
    spark.stop()
    report = stage_records(log_dir)
    print(f"rows: {n}, hot key rows: about {n // 3}")
    for strategy in ("window", "scan"):
        stages = report.get(strategy, [])
        top = max(stages, key=lambda s: s["max_records"]) if stages else {}
        print(f"{strategy}: {timings[strategy]} s; largest shuffle-read stage: {top}")


if __name__ == "__main__":
    main(sys.argv[1], *(sys.argv[2:3]))
