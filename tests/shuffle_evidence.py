"""Measure what keep_first shuffles when one key holds a third of the rows.

Runs keep_first on a skewed input twice, with Spark's map-side group limit
on (the default) and off, with the event log written to a fresh scratch
folder, then reads the task metrics: shuffle records written, and the most
records any single reduce task reads. Prints one JSON line::

    python tests/shuffle_evidence.py
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> dict:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from landfall.operators.relational import keep_first, keep_first_sieved, salted_lookup_left

    logdir = tempfile.mkdtemp(prefix="landfall-evlog-")
    spark = (SparkSession.builder.master("local[4]").appName("shuffle-evidence")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", logdir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.adaptive.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    rows = 60000
    df = spark.range(0, rows, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    # the same keep_first, with Spark's map-side group limit switched off
    for name, threshold in [("keep_first", "1000"), ("without_partial_limit", "-1")]:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
        spark.sparkContext.setJobGroup(name, name)
        keep_first(df, ["k"], ["v"]).write.format("noop").mode("overwrite").save()
    # the sieve: rows of 400 bytes, of which some share has a key of its own
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    wide = spark.sparkContext._jvm.System.currentTimeMillis()  # texts that do not compress to nothing
    for unique in (100, 90, 50, 0):
        key = F.when(F.col("id") % 100 < unique, F.col("id")).otherwise(-1 - F.col("id") % (rows // 2))
        rows_ = spark.range(0, rows, numPartitions=8).select(key.alias("k"), *[
            F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"{wide}{i}")), 256).alias(f"t{i}") for i in range(6)])
        spark.sparkContext.setJobGroup(f"sieve_{unique}", "sieve")
        keep_first_sieved(rows_, ["k"], ["t0"]).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("sieve_off", "no sieve")
    keep_first(rows_, ["k"], ["t0"]).write.format("noop").mode("overwrite").save()
    # lookups: four codes hold all rows
    lookup = spark.range(0, 20000).select(F.col("id").alias("c"), F.col("id").cast("string").alias("label"))
    coded = spark.range(0, rows, numPartitions=8).select((F.col("id") % 4).alias("code"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.sparkContext.setJobGroup("lookup_plain", "plain")
    coded.join(lookup, coded["code"] == lookup["c"], "left").write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("lookup_salted", "salted")
    salted_lookup_left(coded, lookup, "code", "c", unique=True, copies=256).write.format("noop").mode("overwrite").save()
    spark.stop()

    read: dict[str, list[int]] = {}
    bytes_written: dict[str, int] = {}
    stage_group: dict[int, str] = {}
    written: dict[str, int] = {}
    max_read: dict[str, int] = {}
    # Spark 4 writes a rolling log: a directory of event files, in order
    paths = sorted(p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True)
                   if os.path.isfile(p) and os.path.basename(p).startswith("events_"))
    for path in paths:
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = ev.get("Task Metrics") or {}
                    if group is None:
                        continue
                    w = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
                    r = (metrics.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    written[group] = written.get(group, 0) + w
                    bytes_written[group] = bytes_written.get(group, 0) + (
                        metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    if r:
                        read.setdefault(f"{group} {ev['Stage ID']}", []).append(r)
                    max_read[group] = max(max_read.get(group, 0), r)
    def spread(group: str) -> dict[str, int]:
        """Of the group's stage that reads most: the largest and median task."""
        most = sorted(max((v for k, v in read.items() if k.split()[0] == group), key=sum))
        return {"largest": most[-1], "median": most[len(most) // 2], "tasks": len(most)}

    return {"rows": rows, "hot_key_rows": rows // 3,
            "shuffle_records_written": written, "max_records_read_by_one_task": max_read,
            "shuffle_bytes_written": {k: v for k, v in bytes_written.items() if k.startswith("sieve")},
            "lookup_tasks": {g: spread(g) for g in ("lookup_plain", "lookup_salted")}}


if __name__ == "__main__":
    print(json.dumps(main()))
