"""Runs each query in Spark and its SQL in DuckDB, and compares the sorted rows."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "FLOAT": "float",
    "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def difference(frame, connection, sql) -> str | None:
    """What differs between a frame and a SQL answer; None when nothing does."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in answer.description}
    expected = rows_of(names, answer.fetchall())
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    wrong = {f.name: (f.dataType.simpleString(), types[f.name]) for f in frame.schema.fields
             if f.dataType.simpleString() != types[f.name]}
    if wrong:
        return f"types (got, expected): {wrong}"
    if got[1] != expected[1]:
        extra = [r for r in got[1] if r not in set(expected[1])][:3]
        missing = [r for r in expected[1] if r not in set(got[1])][:3]
        return f"{len(got[1])} rows vs {len(expected[1])}; only here {extra}; only there {missing}"
    return None
