"""Compare every query with its SQL twin: python tests/oracle_check.py [folder] [names...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    frame = frame.astype(object).where(frame.notna(), None)
    return frame.sort_values(by=list(frame.columns), key=lambda c: c.astype(str)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got_types = {c: pd.api.types.infer_dtype(got[c].dropna()) for c in got}
    want_types = {c: pd.api.types.infer_dtype(want[c].dropna()) for c in want}
    if got_types != want_types:
        return f"types {got_types} != {want_types}"
    got, want = ordered(got), ordered(want)
    if got.equals(want):
        return None
    for column in got:
        bad = got[column].map(repr) != want[column].map(repr)
        if bad.any():
            at = bad.idxmax()
            return f"{column}: {int(bad.sum())} differ, {got[column][at]!r} != {want[column][at]!r}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle = e.oracle_sql()
    failed = 0
    for name, query in e.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            got = query(spark, folder).toPandas()
            took = time.time() - began
            if name in oracle:
                problem = difference(got, con.execute(oracle[name]).df())
            else:
                problem = "no SQL"
        except Exception as error:  # report and go on
            problem, took, got = str(error)[:800], 0.0, []
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:34s} {len(got):7d} rows {took:6.2f} s  {problem or ''}", flush=True)
    print("failed:", failed)
    sys.exit(bool(failed))
