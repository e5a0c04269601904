"""Run a query and its SQL on the same tables and compare names, types and values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def kind(value) -> object:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, int):
        return value
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def difference(df, con, sql: str) -> str | None:
    """None when both agree, else what differs."""
    relation = con.sql(sql)
    names = sorted(relation.columns)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    types = {c: (df.schema[c].dataType.simpleString(), str(relation.types[relation.columns.index(c)])) for c in names}
    odd = {c: t for c, t in types.items() if t[1].startswith(("HUGEINT", "DECIMAL", "INT128"))}
    if odd:
        return f"types {odd}"
    ours = Counter(tuple(type_tag(r[c]) for c in names) for r in df.toLocalIterator())
    theirs = Counter(tuple(type_tag(v) for v in r) for r in relation.project(", ".join(f'"{c}"' for c in names)).fetchall())
    if ours == theirs:
        wide = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
        loose = {c: t for c, t in types.items() if wide.get(t[0]) not in (None, t[1])}
        return f"values equal but types differ: {loose}" if loose else None
    extra, missing = ours - theirs, theirs - ours
    return (
        f"rows {sum(ours.values())} vs {sum(theirs.values())}; only ours {sum(extra.values())} {list(extra)[:3]}; "
        f"only sql {sum(missing.values())} {list(missing)[:3]} (columns {names})"
    )


def type_tag(value) -> tuple[str, object]:
    return type(value).__name__, kind(value)
