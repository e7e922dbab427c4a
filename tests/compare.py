"""Runs queries against their SQL: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(value, 9) if isinstance(value, float) else value


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs between a Spark result and its SQL, at most three rows."""
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    if not got:
        return ["no rows"]
    found = [f"{len(got)} rows != {len(want)}"] if len(got) != len(want) else []
    return found + [f"{a} != {b}" for a, b in zip(got, want) if repr(a) != repr(b)][:3]


if __name__ == "__main__":
    import __spark_entry__ as entry
    from codecorpus.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in sql:
                found = differences(df, con, sql[name])
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        mark = "FAIL" if found else ("ok" if name in sql else "rows")
        print(f"{mark:5}{name:24}{time.time() - start:7.1f}s", *[f[:700] for f in found], flush=True)
