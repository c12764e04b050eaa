"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "decimal(5,2)": "DECIMAL(5,2)",
}


def compare(df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds = {d[0]: str(d[1]) for d in result.description}
    differ = {
        name: (kind, kinds[name])
        for name, kind in df.dtypes
        if KINDS.get(kind) != kinds[name]
    }
    expected = rows_of(names, result.fetchall())
    found = rows_of(df.columns, df.collect())
    if expected != found:
        return (
            f"rows {sum(found.values())} against {sum(expected.values())};"
            f" only here {list((found - expected).items())[:3]};"
            f" only there {list((expected - found).items())[:3]}"
        )
    if not expected:
        return "no rows on either side"
    return f"types {differ}" if differ else None
