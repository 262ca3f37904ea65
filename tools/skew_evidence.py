"""Skew evidence: the largest task's share of rows, plain window vs ordered scan.

One entity is made to hold a third of all events (the stress case named in the
design rules), then ``lag`` per entity is computed two ways and the rows each
task of the final stage received are counted with ``spark_partition_id()``.

    python tools/skew_evidence.py [sf_dir] [shuffle_partitions]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.operators.sequence import ordered_scan  # noqa: E402
from strata.session import get_spark  # noqa: E402


def task_shares(df):
    # Referencing ``prev`` keeps the window in the plan (otherwise column pruning
    # removes it and only the scan's partitions would be counted).
    per_task = df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.count("prev").alias("with_prev"))
    sizes = [r["n"] for r in per_task.collect()]
    total = sum(sizes)
    return {"tasks": len(sizes), "max_task_rows": max(sizes), "max_share": round(max(sizes) / total, 4)}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    parts = int(sys.argv[2]) if len(sys.argv) > 2 else 16
    spark = get_spark("skew", shuffle_partitions=parts,
                      extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "value")
    # Every third event is re-assigned to entity 0: one key holds a third of the rows.
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("user_id")))
    out = {"rows": hot.count(), "shuffle_partitions": parts}

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    t0 = time.perf_counter()
    plain = hot.withColumn("prev", F.lag("value").over(w))
    out["plain_window"] = task_shares(plain)
    out["plain_window"]["sec"] = round(time.perf_counter() - t0, 2)

    t0 = time.perf_counter()
    scanned = ordered_scan(hot, ["user_id"], ["ts", "event_id"], lags={"prev": ("value", 1)})
    out["ordered_scan"] = task_shares(scanned)
    out["ordered_scan"]["sec"] = round(time.perf_counter() - t0, 2)

    a = {r["event_id"]: r["prev"] for r in plain.select("event_id", "prev").collect()}
    b = {r["event_id"]: r["prev"] for r in scanned.select("event_id", "prev").collect()}
    out["equal_results"] = a == b
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
