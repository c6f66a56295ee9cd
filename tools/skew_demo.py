"""Running median on a hot key: library version vs a per-tow window.

usage: python tools/skew_demo.py [sf_dir]
Input: lineitem shaped as a tow series; every order's first line goes to one
"hot" tow (about a quarter of all rows), the rest to 5,000 ordinary tows.
For both plans it prints the wall time and, per stage, the task count and
the longest / median task time (from the event log), which shows whether the
hot tow is processed by one task or spread over many.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def task_stats(log_dir):
    per_stage = defaultdict(list)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerTaskEnd":
                    ti = ev["Task Info"]
                    per_stage[ev["Stage ID"]].append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
    return per_stage


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from bottomgrid.operators.qc import running_median
    from bottomgrid.session import build_session
    variants = [("library (default bound)", None), ("library (hot tow split off, bound 100k rows)", 100_000),
                ("per-tow window", None)]
    for i, (label, bound) in enumerate(variants * 2):   # the first pass warms the JVM up
        warm = i >= len(variants)
        log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
        spark = build_session("local[8]", shuffle_partitions=16,
                              extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                     "spark.eventLog.compress": "false"})
        li = spark.read.parquet(f"{sf}/lineitem.parquet")
        df = li.select(
            F.when(F.col("l_linenumber") == 1, F.lit("hot"))
             .otherwise((F.col("l_orderkey") % 5000).cast("string")).alias("tow"),
            F.timestamp_add("SECOND", F.col("l_linenumber"), F.col("l_shipdate")).alias("time"),
            F.col("l_orderkey").alias("rid"), F.col("l_quantity").alias("v"))
        t0 = time.time()
        if label.startswith("library"):
            out = running_median(df, "tow", ["time", "rid"], "v", out="m", max_group_rows=bound)
        else:
            w = Window.partitionBy("tow").orderBy("time", "rid").rowsBetween(-2, 2)
            nb = F.collect_list("v").over(w)
            out = df.withColumn("m", F.sort_array(F.concat(nb, F.array_repeat(F.lit(0.0), 5 - F.size(nb))))[2])
        out.write.format("noop").mode("overwrite").save()
        wall = time.time() - t0
        spark.stop()
        if not warm:
            continue
        print(f"{label}: {wall:.2f}s wall")
        for sid, ts in sorted(task_stats(log_dir).items()):
            if len(ts) > 1:
                print(f"  stage {sid:3d} tasks={len(ts):3d} max={max(ts):.2f}s median={statistics.median(ts):.2f}s")


if __name__ == "__main__":
    main()
