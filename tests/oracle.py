"""Runs a registered query in Spark and its oracle in DuckDB and compares the rows."""

from __future__ import annotations

import math
import time
from datetime import date, datetime
from pathlib import Path

import duckdb


LAST_SECONDS: dict[str, float] = {}


def connect(folder: str):
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return str(value)


def _sorted(rows, places):
    cells = [tuple(_cell(row[i]) for i in places) for row in rows]
    return sorted(cells, key=lambda row: tuple((c is not None, str(type(c)), c if c is not None else 0) for c in row))


def compare(spark, run, sql: str, folder: str) -> str | None:
    """None when equal, else what differs."""
    started = time.time()
    frame = run(spark, folder)
    connection = connect(folder)
    relation = connection.sql(sql)
    ours, theirs = sorted(frame.columns), sorted(relation.columns)
    if ours != theirs:
        return f"columns {ours} / {theirs}"
    rows = [tuple(r) for r in frame.collect()]
    LAST_SECONDS["spark"] = time.time() - started
    left = _sorted(rows, [frame.columns.index(c) for c in ours])
    right = _sorted(relation.fetchall(), [relation.columns.index(c) for c in theirs])
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        return f"{len(different)} of {len(left)} rows differ, first {different[0]}"
    return None
