"""Every registered query against its SQL oracle on the smallest shared tables."""

from __future__ import annotations

import os

import pytest
from oracle import compare

import __spark_entry__ as entry_point

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables not present")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["series_code", "timestamp", "value"] and frame.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert compare(spark, QUERIES[name], ORACLES[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    assert frame.schema and frame.collect() is not None


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="shared tables not present")
@pytest.mark.parametrize("name", ["fair_value_fit", "fair_value_rows", "fair_value_signals", "design_matrix"])
def test_fair_value_queries_hold_every_universe(spark, name):
    frame = QUERIES[name](spark, "/root/testdata/sf0.01")
    assert {row[0] for row in frame.select("universe").distinct().collect()} == {"G10", "EM", "CHN"}
