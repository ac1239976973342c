"""Run registered queries against their SQL restatement in DuckDB.

Usage: python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def canonical(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple("<null>" if pd.isna(v) else str(v) for v in r) for r in df[cols].itertuples(index=False)]
    return sorted(rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(f))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def spark_rows(df) -> pd.DataFrame:
    return df.toPandas().convert_dtypes()


def check(spark, con, name, query, sql, sf_dir) -> str:
    t = time.time()
    got = spark_rows(query(spark, sf_dir))
    took = time.time() - t
    want = con.execute(sql).df().convert_dtypes()
    if sorted(got.columns) != sorted(want.columns):
        return f"FAIL columns {sorted(got.columns)} vs {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"FAIL {len(a)} vs {len(b)} rows; spark only {only_a}; sql only {only_b}"
    return f"ok {len(a)} rows {took:.2f}s"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf = sys.argv[1]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, os_ = e.queries(), e.oracle_sql()
    for name in sys.argv[2:] or list(qs):
        try:
            print(name, check(spark, con, name, qs[name], os_[name], sf) if name in os_ else "no sql", flush=True)
        except Exception as ex:
            print(name, "ERROR", str(ex)[:300], flush=True)
