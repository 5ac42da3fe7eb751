"""Runs registered queries against DuckDB: ``python -m checks.verify [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from concurrent.futures import ThreadPoolExecutor

import duckdb

from bazaarlake.session import local_session
from checks.catalog import CHECKS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, name: str, folder: str) -> tuple[str, float, float]:
    check = CHECKS[name]
    started = time.time()
    frame = check.spark(spark, folder)
    got = rows_of(frame.columns, frame.collect())
    took = time.time() - started
    if check.sql is None:
        return f"rows-only {len(got)}", took, 0.0
    started = time.time()
    cursor = connection.execute(check.oracle())
    names = [d[0] for d in cursor.description]
    wanted = rows_of(names, cursor.fetchall())
    sql_took = time.time() - started
    if sorted(names) != sorted(frame.columns):
        return f"COLUMNS {sorted(names)} != {sorted(frame.columns)}", took, sql_took
    if got == wanted:
        return f"ok {len(got)}", took, sql_took
    extra = [r for r in got if r not in set(wanted)][:2]
    lost = [r for r in wanted if r not in set(got)][:2]
    return f"DIFF {len(got)} vs {len(wanted)}; {sorted(names)}\n   spark {extra}\n   sql   {lost}", took, sql_took


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(CHECKS)
    spark, connection = local_session(), connect(folder)

    def one(name: str) -> bool:
        try:
            verdict, took, sql_took = compare(spark, connection.cursor(), name, folder)
        except Exception as error:  # report and go on
            verdict, took, sql_took = f"ERROR {type(error).__name__}: {str(error)[:600]}", 0.0, 0.0
        print(f"{name:28s} {took:6.1f}s {sql_took:6.1f}s  {verdict}", flush=True)
        return verdict.startswith(("ok", "rows-only"))

    with ThreadPoolExecutor(6) as pool:
        good = sum(pool.map(one, names))
    print(f"{len(names)} queries, {len(names) - good} wrong")


if __name__ == "__main__":
    main()
