"""Run a registered query and its SQL on the same tables and compare."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

TESTDATA = "/root/testdata"


def oracle(tables: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(os.listdir(tables)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{file}'")
    return connection


def rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples, columns in name order, numbers at full precision."""

    def plain(value):
        if value is None or value is pd.NaT or value != value:
            return ""
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        if isinstance(value, bytes | bytearray):
            return value.hex()
        return repr(float(value)) if hasattr(value, "__float__") else str(value)

    columns = sorted(frame.columns)
    return sorted(tuple(plain(v) for v in row) for row in frame[columns].itertuples(index=False))


def compare(spark_result: DataFrame, sql: str, connection) -> int:
    expected = connection.execute(sql).df()
    actual = spark_result.toPandas()
    assert sorted(actual.columns) == sorted(expected.columns)
    left, right = rows(actual), rows(expected)
    assert len(left) == len(right)
    for ours, theirs in zip(left, right, strict=True):
        assert ours == theirs
    return len(left)
