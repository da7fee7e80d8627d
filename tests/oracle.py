"""Compare registered queries with their oracle SQL in DuckDB.

Run as a script: python tests/oracle.py SF_DIR [name ...]
"""

from __future__ import annotations

import decimal
import glob
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, decimal.Decimal):
        return f"dec:{value}"
    if isinstance(value, bool):
        return f"bool:{value}"
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} vs {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}\n   got {got[:3]}\n  want {want[:3]}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference\n   got {a}\n  want {b}"
    if not got:
        return "both sides are empty"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from rawstar.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if os.environ.get("ORACLE_PLAIN"):  # no settings of ours, as in somebody else's session
        builder = SparkSession.builder.master("local[8]")
        for key, value in settings.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    else:
        spark = build_session("oracle", "local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            if name in oracles:
                result = compare(spark, con, query, oracles[name], sf_dir)
            else:
                result = None if query(spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:700]}"
        bad += result is not None
        print(f"{'ok ' if result is None else 'BAD'} {name} {time.time() - began:.1f}s {result or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(min(main(), 1))
