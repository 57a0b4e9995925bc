"""Runs a catalogue query and its SQL, and says how their results differ."""

from __future__ import annotations

import math
import re

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _kind(dtype: object) -> str:
    """Column kinds coarse enough for two engines, fine enough to catch a wrong type."""
    text = str(dtype).lower()
    if "hugeint" in text or text.startswith("decimal"):
        return text
    for kind in ("bigint", "double", "bool", "timestamp", "int", "char", "string"):
        if kind in text:
            return {"char": "string", "integer": "int"}.get(kind, kind)
    return text


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(v: object) -> str:
        if isinstance(v, float) and (math.isnan(v) or v == 0):
            return repr(abs(v))
        return repr(v)

    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def plan_faults(name: str, df) -> list[str]:
    """What no plan may hold: Python workers, cross joins, nested loops but in band lookups."""
    text = physical_plan(df)
    faults = [w for w in ("EvalPython", "InPandas", "CartesianProduct") if w in text]
    lookups = ("range_lookup", "impute_bernoulli", "impute_votes", "mean_of_two", "flagged")
    if re.search("BroadcastNestedLoopJoin", text) and not name.startswith(lookups):
        faults.append("BroadcastNestedLoopJoin")
    return faults


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if names, kinds and all rows agree; otherwise the first thing that does not."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: _kind(d[1]) for d in expected.description}
    found = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    if kinds != found:
        return f"columns: expected {kinds}, found {found}"
    want = _rows(names, expected.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        return f"rows: expected {len(want)}, found {len(got)}"
    for w, g in zip(want, got):
        if w != g:
            return f"values: expected {w}, found {g}"
    return None
