"""Run registered queries against their oracle SQL: python tests/run_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from barlake.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    if os.environ.get("ORACLE_PLAIN"):  # the driver's own session: no engine defaults
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        if name not in sqls:
            n = df.count()
            print(f"{name:28s} rows-only {n} rows  {time.time() - t0:.1f}s")
            continue
        try:
            problems = compare(df, con, sqls[name])
        except Exception as exc:  # noqa: BLE001
            problems = [f"error: {type(exc).__name__}: {str(exc)[:400]}"]
        status = "OK" if not problems else "FAIL"
        bad += bool(problems)
        print(f"{name:28s} {status}  {time.time() - t0:.1f}s")
        for p in problems:
            print("    " + p)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
