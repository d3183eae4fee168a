"""Scans of last known values against plain loops, with many ranges per group."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from serieslake.operators.carry import asof_join, carry_last, fill_series


def series(rng, sizes):
    rows = []
    for group, size in sizes.items():
        for at in range(size):
            rows.append((group, at, None if rng.random() < 0.8 else float(at)))
    return rows


@pytest.mark.parametrize("limit", [None, 0, 3])
def test_fill_series(spark, limit):
    rows = series(np.random.default_rng(1), {"hot": 900, "b": 5, "none": 0, "c": 1})
    table = spark.createDataFrame(rows, "g string, at long, v double").repartition(3)
    got = {(r.g, r.at): r.v for r in fill_series(table, "g", [F.col("at")], "v", limit=limit).collect()}
    last = {}
    for group, at, value in rows:
        if value is not None:
            last[group] = (at, value)
        known = last.get(group)
        wanted = known[1] if known and (limit is None or at - known[0] <= limit) else None
        assert got[group, at] == wanted
    assert len(got) == len(rows)


def test_carry_counts_rows_since(spark):
    rows = series(np.random.default_rng(2), {"hot": 400, "b": 30})
    table = spark.createDataFrame(rows, "g string, at long, v double")
    got = carry_last(table, "g", [F.col("at")], F.col("v").isNotNull(), F.col("at"), "seen").collect()
    assert all(r.seen_since == r.at - r.seen for r in got if r.seen is not None)
    assert all((r.seen_since is None) == (r.seen is None) for r in got)


def test_asof_join(spark):
    rng = np.random.default_rng(3)
    rates = [("hot", int(t), int(k), float(k)) for k, t in enumerate(rng.integers(0, 300, 200))] + [("b", 10, 0, 1.0)]
    probes = [("hot", int(t), f"p{k}") for k, t in enumerate(rng.integers(-20, 320, 300))] + [("c", 5, "none")]
    right = spark.createDataFrame(rates, "g string, t int, seq int, rate double")
    left = spark.createDataFrame(probes, "g string, t int, name string")
    got = asof_join(left, right, "g", "t", ["rate"], tie=[F.col("seq")], tolerance=F.lit(4)).collect()
    assert len(got) == len(probes)
    for row in got:
        able = [r for r in rates if r[0] == row.g and r[1] <= row.t]
        newest = max(able, key=lambda r: (r[1], r[2])) if able else None
        assert row.rate == (newest[3] if newest and newest[1] + 4 >= row.t else None)


def test_asof_join_without_rows(spark):
    left = spark.createDataFrame([("a", 1)], "g string, t int")
    right = spark.createDataFrame([], "g string, t int, rate double")
    assert asof_join(left, right, "g", "t", ["rate"]).collect()[0].rate is None
    assert asof_join(left.limit(0), right, "g", "t", ["rate"]).count() == 0
