"""Compares registered queries with their SQL in DuckDB on the same Parquet files."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, fn, sql: str) -> tuple[int, str]:
    """Row count and a description of the first difference (empty if equal)."""
    df = fn(spark, sf_dir)
    ours = _rows(df.columns, df.collect())
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    theirs = _rows(columns, found.fetchall())
    n = sum(ours.values())
    if sorted(df.columns) != sorted(columns):
        return n, f"columns {sorted(df.columns)} and {sorted(columns)}"
    if ours != theirs:
        only = list((ours - theirs).items())[:3]
        lack = list((theirs - ours).items())[:3]
        return n, f"{n} rows and {sum(theirs.values())}; only ours {only}; only SQL {lack}"
    return n, ""


def main():
    from __spark_entry__ import oracle_sql, queries
    from sparkroute.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    conf = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    spark = build_session("oracle", "local[8]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = oracle_sql()
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                n, problem = compare(spark, con, sf_dir, fn, sqls[name])
            else:
                n, problem = fn(spark, sf_dir).count(), "no SQL"
        except Exception as error:
            n, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:22} {n:8} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
