"""Run queries next to their SQL and compare rows.

    python -m catalog.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

from . import oracle, queries


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in queries.TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value: object) -> str:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, decimal.Decimal):
        return "decimal " + str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return "date " + str(value)
    return repr(value)


def rows_of(columns: list[str], rows: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, folder: str, name: str, con: duckdb.DuckDBPyConnection) -> tuple[str, float]:
    """Outcome and seconds of one query; outcome `ok` means equal rows and names."""
    start = time.time()
    df = queries.queries()[name](spark, folder)
    ours = df.collect()
    seconds = time.time() - start
    sql = oracle.oracle_sql().get(name)
    if sql is None:
        return f"{len(ours)} rows, no SQL", seconds
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", seconds
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    if a == b:
        return f"ok {len(a)}", seconds
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"DIFFERENT {len(a)} vs {len(b)}\n  spark {only_a}\n  sql   {only_b}", seconds


def main() -> None:
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name in sys.argv[2:] or queries.queries():
        try:
            outcome, seconds = compare(spark, folder, name, con)
        except Exception as e:  # report and go on with the next query
            outcome, seconds = f"FAILED {type(e).__name__}: {str(e)[:600]}", 0.0
        print(f"{name:32} {seconds:7.2f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main()
