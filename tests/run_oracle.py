"""Compare registered queries with their SQL: ``python -m tests.run_oracle [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tests.oracle import compare, connect


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, failed = connect(sf_dir), 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            df = fn(spark, sf_dir)
            problem = compare(df, con, sql) if sql else (None if df.collect() else "no rows")
        except Exception as e:
            problem = "".join(traceback.format_exception_only(e))[:1500]
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
