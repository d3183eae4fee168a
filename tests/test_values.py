from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import records
from pyspark.sql import functions as F

from serieslake.functions.dates import age_days
from serieslake.operators import reshape, rolling, values
from serieslake.schema import (
    InvalidOrderByError,
    InvalidQueryError,
    PivotTooWideError,
    SeriesCodesRequiredError,
)

D1, D2, D3 = "2024-01-01", "2024-01-02", "2024-01-03"


def test_last_wins_takes_latest_save_and_skips_null(long):
    frame = long([("A", D1, 1.0, 1), ("A", D1, 2.0, 5), ("A", D1, None, 9), ("B", D1, 3.0, 2)], "_seq")
    assert records(values.last_wins(frame), "series_code", "value") == [("A", 2.0), ("B", 3.0)]


def test_last_wins_orders_commits_before_rows(long):
    frame = long([("A", D1, 1.0, 1, 99), ("A", D1, 2.0, 2, 1)], "_version", "_seq")
    assert records(values.last_wins(frame), "value") == [(2.0,)]


def test_last_value_breaks_ties_by_save_order(long):
    frame = long([("A", D1, 1.0, 1), ("A", D2, 2.0, 2), ("A", D2, 3.0, 3), ("A", D3, None, 4)], "_seq")
    assert records(values.last_value(frame)) == [("A", "2024-01-02T00:00:00", 3.0)]


def test_last_value_of_a_hot_series_combines_before_the_shuffle(spark, long):
    rows = [("HOT", D1, float(i), i) for i in range(500)] + [("A", D1, 1.0, 1)]
    frame = long(rows, "_seq").repartition(4)
    plan = values.last_value(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan
    assert ("HOT", 499.0) in records(values.last_value(frame), "series_code", "value")


def test_scan_predicates_sort_and_limit(long):
    frame = long([("A", D1, 1.0), ("A", D2, 2.0), ("B", D3, 3.0)])
    assert records(values.scan(frame, codes=["A"], start=D2), "value") == [(2.0,)]
    assert records(values.scan(frame, end=D2), "value") == [(1.0,), (2.0,)]
    top = values.scan(frame, order_by="value", ascending=False, limit=1)
    assert records(top, "value") == [(3.0,)]
    with pytest.raises(InvalidOrderByError):
        values.scan(frame, order_by="nope")
    with pytest.raises(InvalidQueryError):
        values.scan(frame, order_by="value", limit=0)
    with pytest.raises(SeriesCodesRequiredError):
        values.scan(frame, codes=[])


def test_code_table_is_a_broadcast_semi_join_with_pushed_filters(spark, long, tmp_path):
    long([("A", D1, 1.0), ("B", D2, 2.0)]).write.parquet(str(tmp_path / "v"))
    frame = spark.read.parquet(str(tmp_path / "v"))
    codes = spark.createDataFrame([("A",), ("A",), (None,)], "series_code string")
    found = values.scan(frame, codes=codes, start=D1, end=D2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert "GreaterThanOrEqual(timestamp" in plan
    assert records(found, "series_code") == [("A",)]


def test_exists_lists_only_series_with_rows(long):
    frame = long([("A", D1, None), ("B", D2, 1.0)])
    assert records(values.value_exists(frame)) == [("A", True), ("B", True)]


def test_default_source_routing(spark, long):
    frame = long(
        [("A", D1, 1.0, "bloomberg"), ("A", D1, 9.0, "hawk"), ("B", D1, 2.0, "hawk")], "ticker_source"
    )
    good = spark.createDataFrame([("A", "BBG"), ("B", " Hawkeye ")], "series_code string, default_source string")
    assert records(values.route_by_default_source(frame, good), "series_code", "value") == [("A", 1.0), ("B", 2.0)]
    bad = spark.createDataFrame([("A", None), ("B", "carrier pigeon")], good.schema)
    with pytest.raises(InvalidQueryError):
        values.route_by_default_source(frame, bad)


def test_pivot_drops_timestamps_without_values(long):
    frame = long([("A", D1, 1.0), ("B", D2, None), ("B", D3, 3.0)])
    assert records(reshape.pivot_values(frame, ["A", "B"])) == [
        ("2024-01-01T00:00:00", 1.0, None),
        ("2024-01-03T00:00:00", None, 3.0),
    ]


def test_wide_pivot_agrees_with_narrow_pivot(long):
    codes = [f"S{i:03d}" for i in range(reshape.ONE_PASS_WIDTH + 6)]
    rows = [(c, D1, float(i), 1) for i, c in enumerate(codes)] + [(codes[0], D1, 99.0, 2)]
    frame = long(rows, "_seq")
    wide = reshape.pivot_values(frame, codes).first()
    narrow = reshape.pivot_values(frame, codes[:3]).first()
    assert wide[codes[0]] == narrow[codes[0]] == 99.0
    assert wide[codes[-1]] == len(codes) - 1


def test_pivot_refuses_absurd_width(long):
    with pytest.raises(PivotTooWideError):
        reshape.pivot_values(long([("A", D1, 1.0)]), [str(i) for i in range(reshape.MAX_WIDTH + 1)])
    with pytest.raises(PivotTooWideError):
        reshape.column_codes(long([("A", D1, 1.0), ("B", D1, 1.0)]), width=1)


def test_melt_is_the_inverse_of_pivot(long):
    frame = long([("A", "2024-01-01 10:30:00", 1.0), ("B", "2024-01-02 23:59:59", 2.0)])
    wide = reshape.pivot_values(frame, ["A", "B"])
    assert records(reshape.melt_values(wide, source="hawk")) == [
        ("A", "2024-01-01T00:00:00", 1.0, "hawk"),
        ("B", "2024-01-02T00:00:00", 2.0, "hawk"),
    ]


def test_matrix_renames_and_rejects_duplicates(spark, long):
    frame = long([("EURUSD", D1, 1.1), ("USDJPY", D2, 148.0)])
    catalog = spark.createDataFrame([("EURUSD", "EUR"), ("USDJPY", "JPY")], "series_code string, currency string")
    assert reshape.matrix_by_label(frame, catalog).columns == ["timestamp", "EUR", "JPY"]
    twice = catalog.union(spark.createDataFrame([("EURUSD2", "EUR")], catalog.schema))
    with pytest.raises(ValueError, match="EUR"):
        reshape.matrix_by_label(frame, twice)


@pytest.mark.parametrize("chunk", [25, 100, 1000])
def test_log_volatility_matches_pandas_across_chunk_borders(spark, chunk):
    rng = np.random.default_rng(3)
    days = pd.date_range("2020-01-01", periods=180, freq="6h")
    prices = np.exp(rng.normal(0, 0.01, 180).cumsum())
    prices[40] = -1.0
    frame = spark.createDataFrame(
        [("A", day.to_pydatetime(), float(price)) for day, price in zip(days, prices)],
        "series_code string, timestamp timestamp_ntz, value double",
    )
    result = rolling.log_return_volatility(frame, chunk_size=chunk).orderBy("timestamp").collect()
    kept = pd.Series(prices, index=days)
    kept = np.log(kept[kept > 0]).diff().rolling(21).std(ddof=1).dropna() * np.sqrt(252) * 100
    assert [row["timestamp"] for row in result] == list(kept.index)
    assert np.allclose([row["value"] for row in result], kept.to_numpy())


def test_row_positions_match_global_order(long):
    frame = long([("A", f"2024-01-{d:02d}", float(d)) for d in range(1, 29)] + [("B", D1, 0.0)])
    placed = rolling.row_positions(frame, ["series_code"]).filter("series_code = 'A'")
    assert [r[0] for r in placed.orderBy("timestamp").select("_position").collect()] == list(range(28))


def test_realized_volatility_pads_gaps_and_needs_a_full_window(long):
    rows = [("A", f"2024-01-{d:02d}", v) for d, v in enumerate([1.0, 1.1, None, 1.21, 1.0], start=1)]
    result = rolling.realized_volatility(long(rows), length=2).orderBy("timestamp").collect()
    shown = [None if r[3] is None else round(r[3], 6) for r in result]
    padded = pd.Series([1.0, 1.1, 1.1, 1.21, 1.0])
    expected = padded.pct_change().abs().rolling(2).mean()
    assert shown == [None if np.isnan(v) else round(v, 6) for v in expected]


def test_realized_volatility_survives_a_zero(long):
    rows = [("A", D1, 0.0), ("A", D2, 1.0), ("A", D3, 2.0)]
    result = rolling.realized_volatility(long(rows), length=1).orderBy("timestamp").collect()
    assert [r["realized_volatility"] for r in result] == [None, None, 1.0]


def test_value_counts(long):
    frame = long([("A", D1, 1.0), ("A", D2, None)])
    assert values.count_points(frame).first()[0] == 1
    assert frame.filter(F.col("value").isNull()).count() == 1


def test_age_counts_whole_days_to_the_microsecond(spark):
    frame = spark.sql(
        """SELECT TIMESTAMP_NTZ '2024-02-01' AS now, explode(array(
          TIMESTAMP_NTZ '2024-01-31 00:00:00', TIMESTAMP_NTZ '2024-01-31 00:00:00.000001',
          TIMESTAMP_NTZ '2024-01-30 23:59:59.999999', TIMESTAMP_NTZ '2024-02-01 00:00:00.5')) AS ts"""
    )
    assert [r[0] for r in frame.select(age_days(F.col("now"), F.col("ts"))).collect()] == [1, 0, 1, -1]


def test_row_totals_have_no_widest_row(spark, long):
    rows = [("A", D1, 1.0, 1), ("A", D1, 2.0, 2), ("A", D1, None, 3), ("B", D1, 5.0, 1), ("B", D2, None, 1), ("C", D3, 4.0, 1)]
    few = long(rows, "_seq")
    wide = reshape.pivot_values(few, ["A", "B", "C"])
    assert records(reshape.row_totals(few)) == [("2024-01-01T00:00:00", 2, 7.0), ("2024-01-03T00:00:00", 1, 4.0)]
    assert records(wide, "timestamp") == records(reshape.row_totals(few), "timestamp")
    many = spark.range(reshape.MAX_WIDTH + 1).selectExpr(
        "concat('S', id) AS series_code", "TIMESTAMP_NTZ '2024-01-01' AS timestamp", "1.5D AS value"
    )
    with pytest.raises(PivotTooWideError):
        reshape.column_codes(many)
    assert reshape.row_totals(many).first()[1:] == (reshape.MAX_WIDTH + 1, 1.5 * (reshape.MAX_WIDTH + 1))
