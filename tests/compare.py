"""Run a query and its SQL twin over one folder and compare all rows."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, types as T

KINDS = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.StringType: "VARCHAR",
    T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        assert not math.isnan(value)
        return round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(rows, order) -> list[tuple]:
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=lambda r: [str(v) for v in r]
    )


def differences(df: DataFrame, connection, sql: str) -> list[str]:
    """What differs, in words; empty when both sides agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    for field in df.schema.fields:
        kind = KINDS[type(field.dataType)]
        if types[field.name] not in (kind, {"VARCHAR": "STRING", "BIGINT": "NUMBER"}.get(kind)):
            found.append(f"type of {field.name}: {kind} vs {types[field.name]}")
    columns = sorted(names)
    got = _rows(df.collect(), [df.columns.index(c) for c in columns])
    want = _rows(expected, [names.index(c) for c in columns])
    if len(got) != len(want):
        found.append(f"{len(got)} rows vs {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        found.append(f"{len(bad)} rows differ, first: {str(bad[0])[:600]}")
    return found
