"""Run a registered query and its SQL on the same folder and compare schema kinds, rows and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, dt.datetime):
        return "timestamp"
    return type(value).__name__


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return f"D{v}"
    return f"{_kind(v)}:{v}"


def compare(spark, con, name, build, sql, folder) -> list[str]:
    problems = []
    df = build(spark, folder)
    rows = df.collect()
    result = con.sql(sql)
    names, types = result.columns, [str(t) for t in result.types]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(set(df.columns) ^ set(names))}"]
    simple = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    kinds = dict(zip(names, types))
    for f in df.schema.fields:
        s = simple.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        if s != kinds[f.name].replace("DECIMAL(", "DECIMAL("):
            problems.append(f"type of {f.name}: {s} vs {kinds[f.name]}")
    order = sorted(df.columns)
    ours = sorted([tuple(_norm(r[c]) for c in order) for r in rows], key=str)
    at = [names.index(c) for c in order]
    theirs = sorted([tuple(_norm(r[i]) for i in at) for r in expected], key=str)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} vs {len(theirs)}")
    elif ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
        diff = [f"{c}: {x} vs {y}" for c, x, y in zip(order, *bad[0]) if x != y]
        problems.append(f"{len(bad)} of {len(ours)} rows differ, first: {diff[:6]}")
    if not ours:
        problems.append("no rows")
    return problems
