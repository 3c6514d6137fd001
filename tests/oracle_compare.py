"""Run registered queries next to their SQL and compare columns, row counts and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(name, df, con, sql) -> str | None:
    """None when both sides agree, else what differs first."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"{name}: columns {sorted(df.columns)} against {sorted(rel.columns)}"
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP"}
    for column, kind in zip(rel.columns, rel.types):
        if names.get(spark_types[column]) != str(kind):
            return f"{name}: {column} is {spark_types[column]} against {kind}"
    got = rows_of(df.columns, df.collect())
    want = rows_of(rel.columns, rel.fetchall())
    if len(got) != len(want):
        return f"{name}: {len(got)} rows against {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{name}: {g} against {w}"
    return None
