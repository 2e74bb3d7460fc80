"""Largest per-task shuffle read for each sessionising plan on skewed input.

Moves every third user's traffic of ``events`` onto one client address (a
third of all hits), runs both strategies, and reads Spark's event log
(written to a fresh scratch folder) for the biggest task of every stage.
Prints one JSON line. Usage: python scripts/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from trafficlens.functions.columns import ntz_from_epoch  # noqa: E402
from trafficlens.operators import devices as D  # noqa: E402
from trafficlens.operators import load as L  # noqa: E402
from trafficlens.operators import sessions as S  # noqa: E402
from trafficlens.sources import fixtures as fx  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = fx.table(spark, sf_dir, "events")
    hits = fx.hits(spark, sf_dir).join(events.select("event_id", "user_id"), "event_id")
    hot = F.when(F.col("user_id") % 3 == 0, F.lit("10.0.0.0")).otherwise(F.col("cl_ip"))
    skewed = hits.withColumn("cl_ip", hot).drop("user_id")
    path = os.path.join(log_dir, "skewed")
    skewed.write.parquet(path)
    data = spark.read.parquet(path)
    total = data.count()
    hot_rows = data.where(F.col("cl_ip") == "10.0.0.0").count()
    groups = {}
    # a third of all hits also moved into one second, for the per-bucket aggregate
    hot_second = data.withColumn(
        "date_time",
        F.when(F.col("cl_ip") == "10.0.0.0", ntz_from_epoch(F.lit(1_704_067_200))).otherwise(F.col("date_time")),
    )
    runs = {
        "sessionize_window": lambda: S.sessionize(data, strategy="window"),
        "sessionize_compact": lambda: S.sessionize(data),
        "session_table": lambda: S.session_table(S.sessionize(data)),
        "session_windows": lambda: S.session_windows(data),
        "user_features": lambda: D.user_features(data),
        "device_gap": lambda: D.device_gap(S.sessionize(data)),
        "first_hit_device": lambda: D.first_hit_device(S.sessionize(data)),
        "sessionize_hot_second": lambda: S.sessionize(hot_second),
        "sessionize_hot_second_tie_break": lambda: S.sessionize(hot_second, tie_break="event_id"),
        "load_features_hot_second": lambda: L.load_features(hot_second, "second", ["GET", "POST"]),
    }
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_job, job_group, max_read = {}, {}, {}
    for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(f) or "skewed" in f or f.endswith((".crc", ".parquet")) or "appstatus" in f:
            continue
        for line in open(f):
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = group
            elif kind == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                sid = e["Stage ID"]
                max_read[sid] = max(max_read.get(sid, 0), read)
    for sid, read in max_read.items():
        g = stage_job.get(sid)
        if g:
            groups[g] = max(groups.get(g, 0), read)
    groups = dict(sorted(groups.items()))
    print(json.dumps({"rows": total, "hot_client_rows": hot_rows, "max_task_shuffle_records": groups,
                      "shuffle_partitions": 64, "event_log": log_dir}))


if __name__ == "__main__":
    main()
