"""Compare a Spark result with DuckDB's answer: types, row count and values."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark's type names in DuckDB's spelling.
_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            files = path / "*.parquet" if path.is_dir() else path
            connection.execute(f"create view {name} as select * from '{files}'")
    return connection


def spark_types(df: DataFrame) -> dict[str, str]:
    return {name: _TYPES.get(kind, kind.upper()) for name, kind in df.dtypes}


def rows_of(df: DataFrame) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(row) for row in df.select(*names).collect())


def assert_same(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Types and values agree whatever the order; returns the number of rows."""
    answer = connection.sql(sql)
    types = dict(zip(answer.columns, (str(kind) for kind in answer.types)))
    assert {n: t.replace(" ", "") for n, t in spark_types(df).items()} == {
        n: t.replace(" ", "") for n, t in types.items()
    }
    names = ", ".join(f'"{name}"' for name in sorted(types))
    expected = Counter(answer.select(names).fetchall())
    actual = rows_of(df)
    assert actual == expected, (
        f"only in Spark: {list((actual - expected).items())[:3]}; "
        f"only in DuckDB: {list((expected - actual).items())[:3]}"
    )
    return sum(actual.values())
