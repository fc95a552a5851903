"""Run registered queries next to their SQL and compare the rows.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value if value is None else str(value)


def differences(spark_df, con, sql: str) -> list[str]:
    got = spark_df.toArrow()
    want = con.execute(sql).to_arrow_table()
    found = []
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {got.column_names} and {want.column_names}"]
    cols = sorted(got.column_names)
    types = {"int64": "int", "int32": "int", "int16": "int", "int8": "int"}
    for c in cols:
        a, b = str(got.schema.field(c).type), str(want.schema.field(c).type)
        if a != b and not {a, b} <= {"string", "large_string"}:
            found.append(f"type of {c}: {a} and {b}")
    mine, theirs = (sorted(zip(*[map(plain, t.column(c).to_pylist()) for c in cols]), key=repr) for t in (got, want))
    if len(mine) != len(theirs):
        found.append(f"rows {len(mine)} and {len(theirs)}")
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        found.append(f"{len(bad)} rows differ, first {bad[:2]}")
    return found


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf), oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf)
            if name in sqls:
                found = differences(df, con, sqls[name])
                state = "ok" if not found else "DIFF " + "; ".join(found)
            else:
                state = f"rows {df.count()}"
        except Exception as error:  # report every query, whatever fails
            found, state = [error], f"ERROR {type(error).__name__} {str(error)[:1500]}"
        failed += state.startswith(("DIFF", "ERROR"))
        print(f"{name:24s} {time.time() - start:6.2f}s {state}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
