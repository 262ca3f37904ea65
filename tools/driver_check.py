"""Check the driver contract the way the round driver does: a plain session with
default settings, ``__spark_entry__`` imported by path, every query against its
oracle.

    python tools/driver_check.py [sf_dir] [session_time_zone]
"""

from __future__ import annotations

import importlib.util
import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    tz = sys.argv[2] if len(sys.argv) > 2 else None
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)

    from pyspark.sql import SparkSession

    b = SparkSession.builder.master("local[8]").appName("driver-check").config("spark.ui.showConsoleProgress", "false")
    if tz:
        b = b.config("spark.sql.session.timeZone", tz)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sys.path.insert(0, os.path.join(ROOT, "tests"))
    from oracle import compare, duck

    con = duck(sf_dir)
    out = {"entry_rows": entry.entry(spark).count(), "failures": {}}
    queries, sql = entry.queries(), entry.oracle_sql()
    t0 = time.time()
    for name, fn in queries.items():
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                r = compare(df, con, sql[name])
                if not (r["values_match"] and r["spark_rows"] == r["oracle_rows"]):
                    out["failures"][name] = {k: r.get(k) for k in ("spark_rows", "oracle_rows", "columns_match")}
            else:
                df.count()
        except Exception as e:  # report every query
            out["failures"][name] = f"{type(e).__name__}: {str(e)[:300]}"
    out.update(queries=len(queries), with_sql=len(sql), seconds=round(time.time() - t0))
    spark.stop()
    print(json.dumps(out))
    return 1 if out["failures"] else 0


if __name__ == "__main__":
    raise SystemExit(main())
