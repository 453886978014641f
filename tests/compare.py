"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        return None if math.isnan(value) else repr(float(value))
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return str(value)


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def kind(type_name: str) -> str:
    """Type families that the two engines name differently."""
    name = type_name.lower()
    for family, members in {
        "text": ("string", "varchar"),
        "int32": ("int", "integer"),
        "int64": ("bigint",),
        "float64": ("double",),
        "stamp": ("timestamp", "timestamp_ntz"),
        "flag": ("boolean",),
    }.items():
        if name in members:
            return family
    return name


def mismatch(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, otherwise the first difference."""
    names = spark_df.columns
    ours = rows(names, spark_df.collect())
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    theirs = rows(theirs_names, result.fetchall())
    if sorted(names) != sorted(theirs_names):
        return f"columns {sorted(names)} != {sorted(theirs_names)}"
    ours_types = {f.name: kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    theirs_types = {d[0]: kind(str(d[1])) for d in con.execute(f"DESCRIBE {sql}").fetchall()}
    differing = {n: (t, theirs_types[n]) for n, t in ours_types.items() if t != theirs_types[n]}
    if differing:
        return f"types {differing}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    for a, b in zip(ours, theirs, strict=True):
        if a != b:
            left = {n: v for n, v, w in zip(sorted(names), a, b, strict=True) if v != w}
            right = {n: w for n, v, w in zip(sorted(names), a, b, strict=True) if v != w}
            return f"row {a}: {left} != {right}"
    return None
