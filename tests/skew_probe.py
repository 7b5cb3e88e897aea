"""Skew probe: run skew-prone operators in a session that writes Spark's event log, then report the shuffle
records read by each reduce task (max and mean per stage).

Usage: python tests/skew_probe.py <sf_dir> <scratch_dir>   -> prints one JSON line
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PARTITIONS = 8


def shuffle_read_by_stage(event_dir: str) -> tuple[dict[int, list[int]], dict[int, str]]:
    """Shuffle records read per task, by stage, and the job group of every stage."""
    stages: dict[int, list[int]] = {}
    groups: dict[int, str] = {}
    for path in glob.glob(os.path.join(event_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or not os.path.basename(path).startswith("events_"):
            continue
        with open(path, encoding="utf-8") as fh:
            for line in fh:
                event = json.loads(line)
                kind = event.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (event.get("Properties") or {}).get("spark.jobGroup.id", "")
                    for stage in event.get("Stage IDs", []):
                        groups[stage] = group
                elif kind == "SparkListenerTaskEnd":
                    metrics = event.get("Task Metrics") or {}
                    read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    if read:
                        stages.setdefault(event["Stage ID"], []).append(read)
    return stages, groups


def main(sf_dir: str, scratch: str) -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    events = os.path.join(scratch, "events")
    os.makedirs(events, exist_ok=True)
    spark = (
        SparkSession.builder.master(f"local[{PARTITIONS}]")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{events}")
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", str(PARTITIONS))
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from strata.operators import quality as Q
    from strata.plans import catalog

    sc = spark.sparkContext
    # 1. key uniqueness where one blank key holds a third of the rows
    li = catalog.table(spark, sf_dir, "lineitem").repartition(PARTITIONS)
    hot = li.select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(""))
        .otherwise(F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("k")
    )
    hot_rows = hot.filter(F.col("k") == "").count()
    total_rows = hot.count()
    sc.setJobGroup("dup", "dup")
    dup = {r["name"]: r["observed_count"] for r in Q.evaluate(hot, [Q.unique("k")]).collect()}
    # 2. the customer risk order: few distinct scores, the key breaks the ties
    sc.setJobGroup("sort", "sort")
    catalog.q_customer_risk(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    stages, groups = shuffle_read_by_stage(events)
    summary = {
        str(stage): {"group": groups.get(stage, ""), "tasks": len(v), "max": max(v), "mean": sum(v) / len(v)}
        for stage, v in sorted(stages.items())
    }
    print(json.dumps({"hot_rows": hot_rows, "total_rows": total_rows, "dup": dup, "stages": summary}))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
