"""Run a registered query and its SQL side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def _sorted(rows, columns, order):
    picks = [columns.index(name) for name in order]
    return sorted(tuple(_cell(row[i]) for i in picks) for row in rows)


def differences(frame, connection, sql: str) -> list[str]:
    """What differs in columns, row count or any value; doubles must agree bit for bit."""
    cursor = connection.execute(sql)
    oracle_columns = [column[0] for column in cursor.description]
    oracle_rows = cursor.fetchall()
    rows = [tuple(row) for row in frame.collect()]
    if sorted(frame.columns) != sorted(oracle_columns):
        return [f"columns {sorted(frame.columns)} / {sorted(oracle_columns)}"]
    if len(rows) != len(oracle_rows):
        return [f"rows {len(rows)} / {len(oracle_rows)}"]
    order = sorted(oracle_columns)
    ours, theirs = _sorted(rows, frame.columns, order), _sorted(oracle_rows, oracle_columns, order)
    return [f"{a} / {b}" for a, b in zip(ours, theirs) if a != b][:5]


def plan(frame) -> str:
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return frame._jdf.queryExecution().explainString(mode)
