from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from serieslake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "serieslake-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def long(spark):
    """Builds long value rows from (code, timestamp, value[, seq]) tuples."""

    def build(rows, *extra):
        names = ["series_code", "timestamp", "value", *extra]
        kinds = {"_seq": "bigint", "_version": "bigint", "ticker_source": "string"}
        schema = "series_code string, timestamp string, value double" + "".join(
            f", {name} {kinds[name]}" for name in extra
        )
        frame = spark.createDataFrame([tuple(row) for row in rows], schema)
        return frame.withColumn("timestamp", frame["timestamp"].cast("timestamp_ntz")).select(*names)

    return build


def records(frame, *columns):
    """Rows as a sorted list of tuples, timestamps and dates as text."""
    chosen = columns or frame.columns

    def text(value):
        return value.isoformat() if hasattr(value, "isoformat") else value

    rows = [tuple(text(row[c]) for c in chosen) for row in frame.collect()]
    return sorted(rows, key=lambda row: tuple((c is None, str(c)) for c in row))
