"""Runs registered queries on Spark and their SQL on DuckDB and compares all rows.

    python -m tests.oracle [--sf 0.01] [name part ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

DATA = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    names = [columns[i] for i in order]
    table = [tuple(row[i] for i in order) for row in rows]
    return names, sorted(table, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def compare(spark, con, query, sf_dir: str) -> tuple[str, float, float]:
    start = time.time()
    df = query.run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - start
    if query.sql is None:
        return f"rows only ({len(got[1])})", spent, 0.0
    start = time.time()
    res = con.execute(query.sql)
    want = rows_of([d[0] for d in res.description], res.fetchall())
    sql_time = time.time() - start
    if got[0] != want[0]:
        return f"COLUMNS {got[0]} {want[0]}", spent, sql_time
    if len(got[1]) != len(want[1]):
        return f"COUNT {len(got[1])} {len(want[1])}", spent, sql_time
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return f"VALUES {len(bad)}/{len(got[1])} {got[0]} {bad[0]}", spent, sql_time
    return f"ok ({len(got[1])})", spent, sql_time


def main(args: list[str]) -> int:
    from obslake.registry import QUERIES
    from obslake.session import build_session

    sf = "0.01"
    if "--sf" in args:
        at = args.index("--sf")
        sf = args[at + 1]
        args = args[:at] + args[at + 2 :]
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{DATA}/sf{sf}"
    con = connect(sf_dir)
    failed = 0
    for name, query in QUERIES.items():
        if args and not any(part in name for part in args):
            continue
        try:
            verdict, spent, sql_time = compare(spark, con, query, sf_dir)
        except Exception as exc:  # report and go on
            verdict, spent, sql_time = f"ERROR {type(exc).__name__} {str(exc)[:600]}", 0.0, 0.0
        failed += not verdict.startswith(("ok", "rows"))
        print(f"{name:36s} {spent:6.2f}s {sql_time:6.2f}s  {verdict}", flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
