"""Run every catalog query against its oracle: ``python tests/run_oracle.py [sf_dir] [names...]``."""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import compare, duck  # noqa: E402

from strata.plans.catalog import oracle_sql, queries  # noqa: E402
from strata.session import get_spark  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_spark("oracle", cpus=8, shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                r = compare(df, con, sqls[name])
                ok = r["values_match"] and r["spark_rows"] == r["oracle_rows"]
            else:
                n = df.count()
                r = {"spark_rows": n, "note": "rows-only"}
                ok = True
        except Exception as e:  # report and continue
            r = {"error": f"{type(e).__name__}: {str(e)[:400]}"}
            ok = False
        bad += not ok
        print(("OK  " if ok else "FAIL"), f"{name:34s} {time.time() - t0:6.2f}s", json.dumps(r, default=str)[:600])
    print(f"{len(qs) - bad}/{len(qs)} ok" if not only else f"failures: {bad}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
