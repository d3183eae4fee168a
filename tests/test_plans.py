"""Physical plans that must hold at scale, and continuous ingestion."""

from __future__ import annotations

import pytest
from conftest import records
from pyspark.sql import functions as F

from serieslake.api import DataAPI
from serieslake.operators import joins
from serieslake.registry import QUERIES
from serieslake.session import shared_dir
from serieslake.streaming.ingest import accept_batch, prepare_batch, rejected_counts, rejected_rows, start_ingest

FOLDER = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["last_value", "last_wins", "pivot_last_wins", "value_exists", "resample_last", "quality_values",
     "metadata_union", "role_resolution", "yield_curve", "seasonality_month", "latest_per_pair"],
)
def test_no_window_puts_a_hot_key_into_one_task(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "Window" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["driver_features", "derived_batch", "histogram", "ols_rolling", "fair_value_fit"])
def test_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_last_wins_and_pivot_share_one_shuffle(spark):
    plan = plan_of(QUERIES["pivot_last_wins"](spark, FOLDER))
    assert plan.count("Exchange hashpartitioning") == 1


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    plan = plan_of(QUERIES["value_by_source"](spark, FOLDER))
    assert "o_orderpriority" not in plan and "ReadSchema" in plan
    plan = plan_of(QUERIES["value_range"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_broadcast_only_when_counted_small(spark):
    big = spark.range(1000).withColumn("v", F.lit(1))
    small = spark.range(100)
    hinted = big.join(joins.small_side(small), "id")
    unhinted = big.join(joins.small_side(small, limit=10), "id")
    assert "BroadcastHint" in hinted._jdf.queryExecution().logical().toString() or "broadcast" in hinted._jdf.queryExecution().logical().toString()
    assert "broadcast" not in unhinted._jdf.queryExecution().logical().toString()


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def drops(folder, name, rows):
    (folder / name).write_text("series_code,timestamp,value\n" + "\n".join(rows) + "\n")


def test_streaming_ingest_appends_and_corrects(spark, tmp_path):
    folder = tmp_path / "drops"
    folder.mkdir()
    api = DataAPI(spark, str(tmp_path / "lake"))
    drops(folder, "a.csv", [" A ,2024-01-01,1.0", "A,20240102,N/A", ",2024-01-01,5", "B,2024-01-01,inf", "B,2024-01-02,2"])
    start_ingest(spark, api, str(folder), "BBG", checkpoint=str(tmp_path / "cp"), once=True).awaitTermination()
    assert records(api.values_frame(), "series_code", "value", "ticker_source") == [("A", 1.0, "bloomberg"), ("A", None, "bloomberg")]
    drops(folder, "b.csv", ["A,2024-01-01,1.5"])
    start_ingest(spark, api, str(folder), "BBG", checkpoint=str(tmp_path / "cp"), once=True).awaitTermination()
    assert api.values_frame().count() == 3
    assert api.get_values(["A"]).first()["A"] == 1.5


def test_batch_checks(spark):
    rows = spark.createDataFrame([("A", "2024-01-01", "x"), ("B", "2099-01-01", "1"), ("C", "2024-01-01", "3")], "series_code string, timestamp string, value string")
    kept = accept_batch(prepare_batch(rows, "hawkeye"))
    assert records(kept, "series_code", "ticker_source") == [("C", "hawk")]


@pytest.mark.parametrize("hold", ["series", "row"])
def test_streaming_ingest_keeps_what_it_holds_back(spark, tmp_path, hold):
    folder = tmp_path / "drops"
    folder.mkdir()
    api = DataAPI(spark, str(tmp_path / "lake"))
    lines = ["A,2024-01-01,1", ",2024-01-01,5", "A,soon,6", "B,2024-01-01,inf", "B,2024-01-02,2", "C,2099-01-01,3", "C,2024-01-01,N/A", "C,2024-01-02,4"]
    drops(folder, "a.csv", lines)
    start_ingest(spark, api, str(folder), "BBG", checkpoint=str(tmp_path / "cp"), once=True, hold=hold).awaitTermination()
    accepted = {"series": [("A", 1.0)], "row": [("A", 1.0), ("B", 2.0), ("C", 4.0), ("C", None)]}[hold]
    assert records(api.values_frame(), "series_code", "value") == sorted(accepted, key=lambda r: (r[0], r[1] is None))
    counts = {r.reason: r.n for r in rejected_counts(api).collect()}
    wrong = {"series_code is missing": 1, "timestamp is not readable": 1, "value is not finite": 1, "timestamp is in the future": 1}
    held = {"series held back: value is not finite": 1, "series held back: timestamp is in the future": 2}
    assert counts == (wrong | held if hold == "series" else wrong)
    assert ("A", "soon", "6") in records(rejected_rows(api), "series_code", "timestamp_text", "value_text")
    assert len(accepted) + sum(counts.values()) == len(lines)
