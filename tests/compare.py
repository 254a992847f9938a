"""Run registered queries against DuckDB on the same tables.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None:
            return ("0", "")
        return (type(v).__name__, repr(v))

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query, sql: str | None):
    """None when equal, otherwise what differs; and the number of rows."""
    df = query(spark, sf_dir)
    got_cols, got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(got)
    cur = con.execute(sql)
    want_cols, want = as_rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    for g, w in zip(got, want):
        if g != w:
            return f"first difference {g} != {w}", len(got)
    return None, len(got)


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            problem, n = compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql().get(name))
        except Exception as e:  # report and go on with the next query
            if len(names) < 4:
                traceback.print_exc()
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        mark = "no sql" if name not in entry.oracle_sql() else "ok"
        bad += problem is not None
        print(f"{mark if problem is None else 'FAIL':7}{name:50}{n:8} rows {time.time() - t0:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} right")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
