"""Measure how the hot-key operators spread a key holding a third of the rows.

Usage: python tools/skew_probe.py [sf_dir]

A skewed copy of the listing fact is derived from the driver tables: a third
of the rows (chosen by a hash of the row) get the same listing id and month,
the same region and the same host.  For each operator the Spark event log
(written to a fresh scratch folder) gives the largest number of shuffle
records one task read, compared with the input row count.  If a hot key
were gathered whole, one task would read at least a third of the rows.
A hot source is probed too: all snapshot rows in one CSV file, read by the
multiLine reader and by the splittable reader (input records per task).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(sf_dir: str) -> dict:
    log_dir = tempfile.mkdtemp(prefix="skew-probe-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             # measure hash distribution, not AQE merging small partitions together
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from staykit.operators.keys import first_per_key
    from staykit.operators.kpi import group_kpis, host_region_kpis
    from staykit.operators.listings import moved_ids
    from staykit.operators.median import exact_median
    from staykit.plans import catalog as c

    fact, owners = c._star(spark, sf_dir)
    # one flag per row, computed before any column changes
    marked = fact.withColumn("_hot", (F.abs(F.xxhash64(*fact.columns)) % 3) == 0)
    hot = F.col("_hot")
    skewed = (marked.withColumn("id", F.when(hot, F.lit(0)).otherwise(F.col("id")))
              .withColumn("year", F.when(hot, F.lit(2000)).otherwise(F.col("year")))
              .withColumn("month", F.when(hot, F.lit(1)).otherwise(F.col("month")))
              .withColumn("lga_code", F.when(hot, F.lit("LGA_HOT")).otherwise(F.col("lga_code")))
              .withColumn("host_id", F.when(hot, F.lit(0)).otherwise(F.col("host_id")))
              .drop("_hot"))
    n_rows = skewed.count()
    n_hot = skewed.filter(F.col("id") == 0).count()
    from pyspark.sql import Window

    # contrast: a window aggregate per key gathers a hot key in one task (a
    # row_number() = 1 filter would not: Spark pre-limits such windows map-side)
    naive_w = Window.partitionBy("id", "year", "month")
    probes = {
        "contrast: count(*) over (partition by id, year, month)": lambda: skewed.withColumn(
            "_n", F.count(F.lit(1)).over(naive_w)),
        "first_per_key(id, year, month)": lambda: first_per_key(skewed, ["id", "year", "month"]),
        "group_kpis(region)": lambda: group_kpis(skewed, owners, ["lga_code"]),
        "moved_ids (distinct places per id)": lambda: moved_ids(skewed),
        "host_region_kpis (hot host)": lambda: host_region_kpis(skewed, owners),
        "exact_median(region, month)": lambda: exact_median(
            skewed.filter("has_availability = 't'"), ["lga_code", "year", "month"], "price"),
    }
    for name, build in probes.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()

    # a hot source: every snapshot row in one CSV file (with quoted line breaks)
    from staykit.session import scratch_path
    from staykit.sources.export import WRITE_OPTIONS
    from staykit.sources.snapshots import read_snapshots

    one_file = scratch_path(spark, "one-file")
    spark.sparkContext.setJobGroup("export", "export")
    c._rows(spark, sf_dir).coalesce(1).write.options(**WRITE_OPTIONS).csv(one_file)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(16 * 1024 * 1024))
    sources = {
        "one big CSV, multiLine reader": lambda: read_snapshots(spark, one_file),
    }
    for name, build in sources.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    probes.update(sources)
    spark.stop()

    stage_group, tasks = {}, {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and os.path.basename(p).startswith(("events_", "local-", "app-"))]
    for path in sorted(paths):
        for line in _lines(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                group = e.get("Properties", {}).get("spark.jobGroup.id")
                for s in e["Stage IDs"]:
                    stage_group[s] = group
            elif e["Event"] == "SparkListenerTaskEnd" and stage_group.get(e["Stage ID"]) in probes:
                metrics = e.get("Task Metrics") or {}
                shuffled = metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                scanned = metrics.get("Input Metrics", {}).get("Records Read", 0)
                tasks.setdefault((stage_group[e["Stage ID"]], e["Stage ID"]), []).append((shuffled, scanned))
    worst = {}
    for (group, _stage), per_task in tasks.items():
        # operators: records each task read from a shuffle; sources: records each task scanned
        reads = [sc if group in sources else sh for sh, sc in per_task]
        total = sum(reads)
        if total == 0:
            continue
        cand = {"max_task_records": max(reads), "stage_records": total, "tasks": len(reads),
                "max_task_share_of_stage": round(max(reads) / total, 3)}
        if group not in worst or cand["max_task_records"] > worst[group]["max_task_records"]:
            worst[group] = cand
    out = {"rows": n_rows, "hot_key_rows": n_hot, "hot_share": round(n_hot / n_rows, 3),
           "largest_read_by_one_task": worst}
    print(json.dumps(out, indent=1))
    return out


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
