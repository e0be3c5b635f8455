"""Skew drill: a key holding a third of lineitem's rows, with and without the
skew-safe paths; per-stage task records and times from Spark's event log.

    python skew_drill.py [sf_dir]

The event log goes to a fresh scratch folder (printed); nothing else is written.
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from vigiframe.operators.aggregates import block_ids  # noqa: E402
from vigiframe.operators.weights import join_group_total  # noqa: E402
from vigiframe.session import build_session  # noqa: E402


def summarize(log_dir: str) -> None:
    import zstandard
    stage_group, tasks = {}, collections.defaultdict(list)
    for path in sorted(glob.glob(os.path.join(log_dir, "eventlog_v2_*", "events_*"))):
        with open(path, "rb") as fh:
            stream = zstandard.ZstdDecompressor().stream_reader(fh) if path.endswith(".zstd") else fh
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    for s in e["Stage IDs"]:
                        stage_group[s] = (e.get("Properties") or {}).get("spark.jobGroup.id")
                elif e["Event"] == "SparkListenerTaskEnd":
                    info, metrics = e["Task Info"], e.get("Task Metrics") or {}
                    read = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    tasks[e["Stage ID"]].append((info["Finish Time"] - info["Launch Time"], read))
    for stage, ts in sorted(tasks.items()):
        recs = [r for _, r in ts]
        if len(ts) < 8 or max(recs) < 20_000:
            continue
        times = [t for t, _ in ts]
        print(f"{stage_group.get(stage)} stage {stage}: {len(ts)} tasks, records max/median "
              f"{max(recs)}/{int(statistics.median(recs))}, ms max/median {max(times)}/{int(statistics.median(times))}")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    spark = build_session(shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    li = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet"))
    hot = F.when(F.col("l_partkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey"))
    df = li.select(hot.alias("k"), F.col("l_quantity").cast("long").alias("v"),
                   "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    threshold = max(1, df.count() // 30)
    for label, rows in (("totals-unsalted", None), ("totals-salted", threshold)):
        spark.sparkContext.setJobGroup(label, label)
        join_group_total(df, ["k"], "v", "t", hot_rows=rows).write.format("noop").mode("overwrite").save()
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    for label, rows in (("blocks-window", 1 << 62), ("blocks-hot-path", threshold)):
        spark.sparkContext.setJobGroup(label, label)
        block_ids(df, ["k"], order, 25, hot_rows=rows).write.format("noop").mode("overwrite").save()
    spark.stop()
    print(f"event log: {log_dir}")
    summarize(log_dir)


if __name__ == "__main__":
    main()
