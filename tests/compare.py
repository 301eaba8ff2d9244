"""Run queries on Spark and their SQL on DuckDB and compare rows, types of columns and values.

    python tests/compare.py <sf dir> [query ...]
"""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)


def differences(spark_df, con, sql):
    result = con.sql(sql)
    ours, theirs = sorted(spark_df.columns), sorted(result.columns)
    if ours != theirs:
        return f"columns {ours} != {theirs}"
    a, b = rows_of(spark_df.columns, spark_df.collect()), rows_of(result.columns, result.fetchall())
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"rows {len(a)} != {len(b)}; ours {only_a[:3]}; theirs {only_b[:3]}"


def main():
    import __spark_entry__ as contract
    from conftest import make_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    queries, sql = contract.queries(), contract.oracle_sql()
    for name in wanted or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = differences(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:32} {time.time() - start:6.1f}s {problem[:3000] or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
