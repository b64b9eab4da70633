"""Runs a registered query and its SQL check on the same tables and compares the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("", "null")
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        return ("n", repr(value + 0.0))
    if isinstance(value, int):
        return ("n", repr(float(value)))
    return (type(value).__name__, str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, sf_dir: str, query, sql: str, con) -> str | None:
    """None when both give the same columns and rows, else what differs first."""
    df = query(spark, sf_dir)
    mine_names, mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    sql_names, theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if mine_names != sql_names:
        return f"columns {mine_names} vs {sql_names}"
    if len(mine) != len(theirs):
        extra = [r for r in mine if r not in set(theirs)][:2] if len(mine) < 20000 else ""
        return f"rows {len(mine)} vs {len(theirs)} {extra}"
    for a, b in zip(mine, theirs):
        if a != b:
            cells = [(n, x, y) for n, x, y in zip(mine_names, a, b) if x != y]
            return f"{cells[:3]} in {a[:4]}"
    return None
