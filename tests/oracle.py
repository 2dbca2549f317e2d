"""A Spark result and a DuckDB result as the same multiset of rows."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of_sql(con, sql: str, columns: list[str]) -> Counter:
    names = ", ".join(f'"{c}"' for c in columns)
    return Counter(tuple(map(plain, r)) for r in con.sql(f"SELECT {names} FROM ({sql})").fetchall())


def rows_of_spark(df) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(map(plain, r)) for r in df.select(*columns).collect())
