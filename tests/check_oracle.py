"""`python tests/check_oracle.py FOLDER [query ...]`: run queries next to their SQL."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path[:0] = [os.path.dirname(__file__), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

import oracle
import __spark_entry__ as entry
from pyspark.sql import SparkSession


def main(folder: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = oracle.connect(folder), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            got = run(spark, folder).toPandas()
            took = time.time() - began
            if name not in twins:
                verdict = "rows only"
            else:
                found = oracle.differences(got, con.execute(twins[name]).df())
                verdict, bad = ("; ".join(found) or "ok"), bad + bool(found)
        except Exception:
            verdict, took, bad = traceback.format_exc()[-900:], time.time() - began, bad + 1
            got = []
        print(f"{name:24} {len(got):7} rows {took:6.2f}s  {verdict}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
