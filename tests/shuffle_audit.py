"""Shuffle audit: run every registered query with Spark's event log on and report, per query, the shuffle bytes
written, the input rows read and the task count (read from the event log, no UI).

Usage: python tests/shuffle_audit.py <sf_dir> <scratch_dir>   -> one "AUDIT ..." line per query
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage_metrics(event_dir: str) -> tuple[dict[int, str], dict[int, list[int]]]:
    """Job group of every stage and per-stage totals [shuffle bytes written, input records, tasks]."""
    groups: dict[int, str] = {}
    stats: dict[int, list[int]] = {}
    for path in glob.glob(os.path.join(event_dir, "**", "events_*"), recursive=True):
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
                    written = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    read = (metrics.get("Input Metrics") or {}).get("Records Read", 0)
                    total = stats.setdefault(event["Stage ID"], [0, 0, 0])
                    total[0] += written
                    total[1] += read
                    total[2] += 1
    return groups, stats


def main(sf_dir: str, scratch: str) -> None:
    from pyspark.sql import SparkSession

    events = os.path.join(scratch, "events")
    os.makedirs(events, exist_ok=True)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{events}")
        .config("spark.eventLog.compress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from strata.plans import catalog
    from strata.session import apply_session_contract

    apply_session_contract(spark)
    sc = spark.sparkContext
    for name, query in catalog.QUERIES.items():
        sc.setJobGroup(name, name)
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    groups, stats = stage_metrics(events)
    per_query: dict[str, list[int]] = {}
    for stage, (written, read, tasks) in stats.items():
        total = per_query.setdefault(groups.get(stage, "?"), [0, 0, 0])
        total[0] += written
        total[1] += read
        total[2] += tasks
    for name, (written, read, tasks) in sorted(per_query.items(), key=lambda item: -item[1][0]):
        print(f"AUDIT {name:28s} shuffle_bytes={written:>10d} input_rows={read:>9d} tasks={tasks}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
