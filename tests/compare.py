"""Compare a registered query with its SQL text on the same Parquet tables."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both give the same columns and the same bag of rows."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but oracle {sorted(names)}"
    expected, actual = _bag(names, result.fetchall()), _bag(df.columns, df.collect())
    missing, extra = expected - actual, actual - expected
    if not missing and not extra:
        return ""
    return (
        f"{actual.total()} rows, oracle {expected.total()}; "
        f"missing {missing.total()} {list(missing)[:2]}; extra {extra.total()} {list(extra)[:2]}"
    )
