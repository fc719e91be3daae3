"""Run registered queries beside their SQL in DuckDB: `python -m checks.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from vitrine.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, date) else value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, sf: str, name: str) -> str | None:
    """None when both results hold the same rows, else what differs first."""
    df = QUERIES[name](spark, sf)
    mine = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return None
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    theirs = rows_of(columns, found.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} / {len(theirs)} rows, first {mine[:1]} / {theirs[:1]}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} rows differ: {wrong[0][0]} / {wrong[0][1]}" if wrong else None


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in names:
        started = time.time()
        try:
            found = difference(spark, con, sf, name)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - started:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
