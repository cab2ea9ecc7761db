"""Compare a Spark result with the result of a SQL text in DuckDB, row by row."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return ("double", f"{value:.9g}")
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    expected = connection.sql(sql)
    if sorted(df.columns) != sorted(expected.columns):
        return f"columns {sorted(df.columns)} and {sorted(expected.columns)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(expected.columns, expected.fetchall())
    if got == want:
        return None
    extra, missing = list((got - want).items()), list((want - got).items())
    return (
        f"{sum(got.values())} rows and {sum(want.values())} expected; "
        f"{len(extra)} only in Spark, e.g. {extra[:2]}; {len(missing)} missing, e.g. {missing[:2]}"
    )
