"""Dev loop: run registered queries in Spark and DuckDB and report differences.

usage: python tests/devcheck.py [sf_dir] [key ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import diff, duck, run_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    # a plain session, as the driver's check uses (no tuned settings)
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        t0 = time.time()
        sp = qs[k](spark, sf_dir).toPandas()
        t1 = time.time()
        if k not in sqls:
            print(f"{k:28s} spark rows={len(sp)} ({t1 - t0:.1f}s) [no oracle]")
            continue
        dk = run_oracle(con, sqls[k])
        problems = diff(sp, dk)
        status = "OK " if not problems else "BAD"
        bad += bool(problems)
        print(f"{status} {k:28s} rows spark={len(sp)} duck={len(dk)} ({t1 - t0:.1f}s)")
        for p in problems:
            print("     ", p[:400])
    print("mismatching:", bad)


if __name__ == "__main__":
    main()
