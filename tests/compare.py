"""Run registered queries in Spark and DuckDB and compare the rows."""

from __future__ import annotations

import contextlib
import io
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "boolean": "BOOLEAN"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def plan_of(df) -> str:
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain()
    return printed.getvalue()


def difference(spark, con, sf_dir: str, run, sql: str) -> str | None:
    df = run(spark, sf_dir)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        if node in plan_of(df):
            return f"{node} in the plan"
    ours = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns differ: {sorted(set(df.columns) ^ set(columns))}"
    kinds = {name: kind for name, kind, *_ in con.execute(f"describe {sql}").fetchall()}
    for f in df.schema.fields:
        if str(kinds[f.name]) != TYPES.get(f.dataType.simpleString()):
            return f"{f.name} is {f.dataType.simpleString()} against {kinds[f.name]}"
    if not ours:
        return "no rows"
    if ours != theirs:
        only, missing = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only ours {sum(only.values())}: {list(only)[:2]}; only theirs: {list(missing)[:2]}"
        )
    return None
