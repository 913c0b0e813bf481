"""Compare every registered query with its DuckDB oracle at one scale (developer check).

    python tests/run_oracles.py /root/testdata/sf0.1 [query ...] [--tz America/Los_Angeles]
"""

from __future__ import annotations

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)


def main(argv: list[str]) -> int:
    from oracle import compare, duck
    from pyspark.sql import SparkSession

    from ledgerlens.plans.catalog import load

    tz = None
    if "--tz" in argv:
        i = argv.index("--tz")
        tz = argv[i + 1]
        argv = argv[:i] + argv[i + 2:]
    sf, names = argv[0], argv[1:]
    b = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
    if tz:
        b = b.config("spark.sql.session.timeZone", tz)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    reg, con, bad = load(), duck(sf), []
    for n in names or sorted(reg):
        t0 = time.time()
        try:
            rows = compare(reg[n].build(spark, sf), con, reg[n].sql)
            print(f"OK   {n} rows={rows} {time.time() - t0:.1f}s", flush=True)
        except Exception as e:  # report and continue
            bad.append(n)
            print(f"FAIL {n}: {str(e)[:800]}", flush=True)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
