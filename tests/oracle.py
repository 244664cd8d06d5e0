"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import datetime
import decimal
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def kind(type_name: str) -> str:
    t = str(type_name).lower()
    for names, k in (
        (("int64", "bigint", "hugeint"), "int64"), (("int32", "integer"), "int32"),
        (("double",), "double"), (("string", "varchar", "large_string"), "string"),
        (("bool",), "bool"),
    ):
        if t.startswith(names):
            return k
    return t


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, float):
        return (1, repr(value + 0.0))
    if isinstance(value, (decimal.Decimal, datetime.date)):
        return (1, str(value))
    return (1, repr(value))


def rows(table) -> tuple[list, list]:
    names = sorted(table.column_names)
    kinds = [(n, kind(table.schema.field(n).type)) for n in names]
    cols = [table.column(n).to_pylist() for n in names]
    return kinds, sorted(tuple(cell(v) for v in r) for r in zip(*cols))


# Joins that pair every row with every row; none is allowed in a registered query.
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin")


def compare(spark, name, run, sql, folder, con=None) -> tuple[str | None, int, float, float]:
    """(difference or None, rows, Spark seconds, SQL seconds)."""
    t0 = time.time()
    df = run(spark, folder)
    got = df.toArrow()
    t1 = time.time()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in BANNED:
        if banned in plan:
            return f"plan holds {banned}", got.num_rows, t1 - t0, 0.0
    if sql is None:
        return None, got.num_rows, t1 - t0, 0.0
    want = (con or connect(folder)).sql(sql).to_arrow_table()
    t2 = time.time()
    gk, gr = rows(got)
    wk, wr = rows(want)
    problem = None
    if gk != wk:
        problem = f"schema: got {gk}, want {wk}"
    elif gr != wr:
        only_g, only_w = sorted(set(gr) - set(wr)), sorted(set(wr) - set(gr))
        problem = f"rows {len(gr)} vs {len(wr)}; only Spark {only_g[:3]}; only SQL {only_w[:3]}"
    return problem, len(gr), t1 - t0, t2 - t1
