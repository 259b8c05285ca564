"""Run named queries in Spark and DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os
import time

import duckdb

import __spark_entry__ as contract


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    frame = contract.queries()[name](spark, sf_dir)
    got = _sorted([tuple(r) for r in frame.collect()], frame.columns)
    cursor = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    want = _sorted(cursor.fetchall(), names)
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None


if __name__ == "__main__":
    import sys

    from pulseforge import session

    sf_dir = sys.argv[1]
    spark = session.build(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in sys.argv[2:] or contract.queries():
        start = time.time()
        problem = compare(spark, con, name, sf_dir)
        print(f"{name:34s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}"[:600], flush=True)
