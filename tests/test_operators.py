from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from conftest import records
from pyspark.sql import functions as F

from serieslake.functions import dates
from serieslake.operators import charts, derived, periods, quality
from serieslake.schema import (
    FrameValidationError,
    InvalidParentSeriesCountError,
    UnknownCalcTypeError,
)

# -- derived -------------------------------------------------------------------------------


def dependencies(spark, rows):
    return spark.createDataFrame(rows, "series_code string, parent_series_code string, calc_type string")


def test_every_formula(spark, long):
    day = "2024-01-01"
    frame = long([("A", day, 10.0), ("B", day, 4.0), ("C", day, 3.0), ("Z", day, 0.0), ("A", "2024-01-02", 1.0)])
    needed = dependencies(
        spark,
        [
            ("spread", "A|B", "spread"), ("fly", "A | B | C", "FLY"), ("box", "A|B|C|Z", "Box"),
            ("ratio", "A|B", "RATIO"), ("ratio0", "A|Z", "RATIO"), ("inv", "A|B", "SPREAD_INV"),
            ("rinv", "A|B", "RATIO_INV"), ("self", "A|A", "SPREAD"), ("gone", "A|MISSING", "SPREAD"),
            ("none", None, "SPREAD"),
        ],
    )
    result = records(derived.derive_series(frame, needed), "series_code", "value")
    assert result == [
        ("box", 3.0), ("fly", 5.0), ("inv", -6.0), ("ratio", 2.5), ("ratio0", None),
        ("rinv", 0.4), ("self", 0.0), ("self", 0.0), ("spread", 6.0),
    ]


def test_parents_saved_twice_use_the_last_save(spark, long):
    frame = long([("A", "2024-01-01", 1.0, 1), ("A", "2024-01-01", 5.0, 2), ("B", "2024-01-01", 2.0, 1)], "_seq")
    result = derived.derive_series(frame, dependencies(spark, [("d", "A|B", "SPREAD")]))
    assert records(result, "value") == [(3.0,)]


def test_bad_dependencies(spark, long):
    frame = long([("A", "2024-01-01", 1.0)])
    with pytest.raises(UnknownCalcTypeError):
        derived.derive_series(frame, dependencies(spark, [("d", "A", "MAGIC")]))
    with pytest.raises(InvalidParentSeriesCountError):
        derived.derive_series(frame, dependencies(spark, [("d", "A", "SPREAD")]))


def test_custom_calculator(spark, long):
    derived.register_calculator("mean2", derived.Calculator(2, row=lambda p: (p[0] + p[1]) / 2))
    try:
        frame = long([("A", "2024-01-01", 1.0), ("B", "2024-01-01", 3.0)])
        result = derived.derive_series(frame, dependencies(spark, [("m", "A|B", "MEAN2")]))
        assert records(result, "value") == [(2.0,)]
    finally:
        del derived.CALCULATORS["MEAN2"]
    with pytest.raises(ValueError):
        derived.register_calculator("none", derived.Calculator(1))


def test_split(spark):
    codes = spark.createDataFrame([("A",), ("D",)], "series_code string")
    found, primary = derived.split_derived(codes, dependencies(spark, [(" D ", "A|B", "SPREAD")]))
    assert records(found) == [("D",)] and records(primary) == [("A",)]


# -- calendar ------------------------------------------------------------------------------


def pandas_conform(frame: pd.DataFrame, primary: str | None, limit: int = 3) -> pd.DataFrame:
    known = frame[primary].dropna() if primary else frame
    grid = pd.bdate_range(known.index.min(), known.index.max())
    return frame.reindex(grid).ffill(limit=limit)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_conform_matches_reindex_and_limited_fill(spark, seed):
    rng = np.random.default_rng(seed)
    days = pd.date_range("2023-12-28", periods=60, freq="D")
    days = days[np.sort(rng.choice(60, 30, replace=False))]
    rate = pd.Series(np.where(rng.random(30) < 0.5, rng.normal(size=30), np.nan), index=days)
    other = pd.Series(np.where(rng.random(30) < 0.7, rng.normal(size=30), np.nan), index=days)
    frame = pd.DataFrame({"rate": rate, "other": other})
    rows = [
        ("P", day.date(), None if math.isnan(r) else float(r), None if math.isnan(o) else float(o))
        for day, r, o in zip(days, rate, other)
    ]
    wide = spark.createDataFrame(rows, "pair string, day date, rate double, other double")
    for primary in ("rate", None):
        ours = periods.conform_to_business_days(
            wide, keys=["pair"], columns=["rate", "other"], primary=primary, day="day"
        ).orderBy("day").collect()
        expected = pandas_conform(frame, primary)
        assert [row["day"] for row in ours] == list(expected.index)
        for column in ("rate", "other"):
            theirs = [None if math.isnan(v) else v for v in expected[column]]
            assert [row[column] for row in ours] == theirs


def test_conform_discards_weekend_rows(long):
    frame = long([("A", "2024-01-05", 1.0), ("A", "2024-01-06", 9.0), ("A", "2024-01-09", 2.0)])
    assert records(periods.conform_series(frame), "timestamp", "value") == [
        ("2024-01-05T00:00:00", 1.0), ("2024-01-08T00:00:00", 1.0), ("2024-01-09T00:00:00", 2.0),
    ]


def test_month_window_clamps_month_ends(long):
    rows = [("A", f"2024-02-{d}", 1.0) for d in (28, 29)] + [("A", "2024-03-01", 2.0), ("A", "2024-05-31", 3.0), ("A", "2024-06-01", 4.0)]
    assert records(periods.month_window(long(rows), "2024-05-31", 3), "value") == [(2.0,), (3.0,)]


def test_resample_labels(long):
    frame = long([("A", "2024-01-01 09:00:00", 1.0), ("A", "2024-01-07 10:00:00", 2.0), ("A", "2024-02-15", 3.0)])
    assert records(periods.resample_last(frame, "W"), "period", "value")[0] == ("2024-01-07T00:00:00", 2.0)
    assert records(periods.resample_last(frame, "ME"), "period", "value") == [("2024-01-31T00:00:00", 2.0), ("2024-02-29T00:00:00", 3.0)]
    assert records(periods.resample_last(frame, "Q"), "period", "value") == [("2024-03-31T00:00:00", 3.0)]
    assert records(periods.resample_last(frame, "Y"), "period", "value") == [("2024-12-31T00:00:00", 3.0)]
    with pytest.raises(ValueError):
        periods.resample_last(frame, "fortnight")


def test_day_list_is_inclusive_and_may_be_empty(spark):
    assert periods.day_list(spark, "2024-02-28", "2024-03-01").count() == 3
    assert periods.day_list(spark, "2024-03-01", "2024-02-28").count() == 0


def test_parse_timestamp_layouts(spark):
    texts = ["2024-01-15", "20240115", "2024-01-15T10:30:00Z", "2024-01-15T10:30:00+02:00", "15 Jan 2024", "January 5, 2024", "", "nope", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = [r[0] for r in frame.select(dates.parse_timestamp(F.col("t"))).collect()]
    shown = [None if p is None else p.isoformat() for p in parsed]
    assert shown == [
        "2024-01-15T00:00:00", "2024-01-15T00:00:00", "2024-01-15T10:30:00", "2024-01-15T08:30:00",
        "2024-01-15T00:00:00", "2024-01-05T00:00:00", None, None, None,
    ]


# -- quality -------------------------------------------------------------------------------


def test_metadata_failures_by_category(spark):
    frame = spark.createDataFrame(
        [
            ("A", "a", "T", "F", None, None, "2024-01-01", "2024-02-01"),
            ("A", "a2", "T", None, None, None, None, "2024-02-01"),
            (None, "n", None, None, None, None, None, None),
            ("  ", " ", None, None, "SPREAD", None, "2024-03-01", "2024-02-01"),
            ("B", None, None, None, "SPREAD", "X|Y", "junk", "2024-02-01"),
        ],
        "series_code string, series_name string, bbg_ticker string, bbg_field string, calc_type string, "
        "parent_series_code string, valid_from string, valid_to string",
    )
    failures = quality.metadata_failures(frame)
    counts = dict(records(quality.failure_counts(failures)))
    assert counts == {"duplicate": 2, "null": 4, "pairing": 2, "other": 1}
    assert quality.failure_examples(failures, shown=1).count() == 4
    with pytest.raises(FrameValidationError):
        quality.metadata_failures(frame.drop("series_name"))


def test_value_failures(long):
    frame = long([("A", "2024-01-01", None), ("B", "2024-01-01", float("inf")), ("B", "2099-01-01", 1.0), ("C", "2024-01-01", 1.0), ("C", "2024-01-01", 2.0)])
    assert records(quality.value_failures(frame)) == [
        ("A", "series has no data", 1), ("B", "timestamp is in the future", 1),
        ("B", "value is not finite", 1), ("C", "timestamp is repeated", 1),
    ]
    assert quality.value_failures(frame.limit(0)).count() == 0


def test_gate_and_required_columns(spark):
    frame = spark.createDataFrame([("A", 1.0), ("B", float("nan")), ("C", None), ("D", 7.0)], "k string, v double")
    rule = quality.Rule("v range", "range", quality.out_of_range("v", 0, 5, nullable=False))
    assert quality.gate(frame, [rule]) == {"v range": 3}
    assert records(quality.drop_failing(frame, ["k"], [rule]), "k") == [("A",)]
    assert quality.gate(frame.filter("k = 'A'"), [rule]) == {}
    with pytest.raises(FrameValidationError, match="v"):
        quality.require_known(frame, ["k", "v"])
    with pytest.raises(FrameValidationError, match="w"):
        quality.require_columns(frame, ["w"])


# -- charts --------------------------------------------------------------------------------


def sample(spark, n=200, seed=0, names=("A", "B", "C")):
    rng = np.random.default_rng(seed)
    days = pd.date_range("2022-01-01", periods=n)
    wide = pd.DataFrame({name: rng.normal(size=n).round(1) for name in names}, index=days)
    wide = wide.mask(rng.random(wide.shape) < 0.2)
    rows = [(c, d.to_pydatetime(), None if math.isnan(v) else float(v)) for c in wide for d, v in wide[c].items()]
    return wide, spark.createDataFrame(rows, "series_code string, timestamp timestamp_ntz, value double")


def brute_kendall(x, y):
    pairs = list(itertools.combinations(range(len(x)), 2))
    signs = [np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i, j in pairs]
    tx = sum(x[i] == x[j] for i, j in pairs)
    ty = sum(y[i] == y[j] for i, j in pairs)
    return sum(signs) / math.sqrt((len(pairs) - tx) * (len(pairs) - ty))


@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
def test_correlations(spark, method):
    wide, frame = sample(spark)
    ours = {(r[0], r[1]): r[2] for r in charts.correlation_matrix(frame, list(wide), method).collect()}
    for a, b in itertools.product(wide, wide):
        both = wide[[a, b]].dropna() if a != b else wide[[a]].dropna()
        x, y = both[a].to_numpy(), both[b].to_numpy()
        if method == "kendall":
            expected = brute_kendall(x, y)
        else:
            x, y = (pd.Series(v).rank() if method == "spearman" else v for v in (x, y))
            expected = np.corrcoef(x, y)[0, 1]
        assert ours[a, b] == pytest.approx(expected, abs=6e-5)
    with pytest.raises(ValueError):
        charts.correlation_matrix(frame, ["A"])


def test_histogram_matches_numpy(spark):
    wide, frame = sample(spark, seed=4)
    flat = spark.createDataFrame([("F", wide.index[0].to_pydatetime(), 2.0)], frame.schema)
    ours = charts.histogram(frame.union(flat), 7)
    for name in wide:
        counts, edges = np.histogram(wide[name].dropna(), bins=7)
        rows = ours.filter(F.col("series_code") == name).orderBy("bin").collect()
        assert np.allclose([r["bin_low"] for r in rows], edges[:-1])
        assert sum(r["n"] for r in rows) == counts.sum()
    assert ours.filter("series_code = 'F'").agg(F.sum("n"), F.min("bin_low")).first()[:] == (1, 1.5)


@pytest.mark.parametrize("small", [True, False])
def test_percentiles_are_exact_with_and_without_the_sketch(spark, monkeypatch, small):
    wide, frame = sample(spark, n=301, seed=5)
    if not small:
        monkeypatch.setattr(charts, "SKETCH_ACCURACY", 50)
        monkeypatch.setattr(charts, "SKETCH_ROWS", 0)
    ours = {r["series_code"]: r for r in charts.boxplot(frame).collect()}
    for name in wide:
        known = wide[name].dropna()
        for column, q in (("low", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("high", 1)):
            assert ours[name][column] == pytest.approx(np.quantile(known, q))


def test_ohlc_matches_pandas(spark):
    wide, frame = sample(spark, seed=6)
    ours = charts.ohlc(frame).filter("series_code = 'A'").orderBy("period").collect()
    bars = wide["A"].dropna().resample("W").agg(["first", "max", "min", "last"]).dropna()
    assert [r["period"] for r in ours] == list(bars.index)
    assert [tuple(r)[2:] for r in ours] == [tuple(b) for b in bars.to_numpy()]


def test_seasonality_and_calendar(spark):
    wide, frame = sample(spark, n=500, seed=7)
    ours = {(r["year"], r["slot"]): r["mean"] for r in charts.seasonality(frame.filter("series_code = 'B'"), "dayofweek").collect()}
    known = wide["B"].dropna()
    expected = known.groupby([known.index.year, known.index.dayofweek]).mean()
    assert ours == pytest.approx(expected.to_dict())
    assert charts.calendar_values(frame).filter("series_code = 'B'").count() == (known.index.year == 2023).sum()
    with pytest.raises(ValueError):
        charts.seasonality(frame, "fortnight")


def test_curves(spark, long):
    frame = long([("S2", "2024-01-01", 2.0), ("S2", "2024-03-01", 2.5), ("S10", "2024-02-01", 10.0), ("S1", "2024-01-01", None)])
    tenors = spark.createDataFrame([("S10", "10Y"), ("S2", "2Y"), ("S1", "1M"), ("X", None)], "series_code string, tenor string")
    curve = charts.term_structure(frame, tenors, ["2024-01-15", "2024-03-15"]).collect()
    assert [(r["as_of"], r["series_code"], r["value"]) for r in curve] == [
        ("2024-01-15", "S2", 2.0), ("2024-01-15", "S10", None), ("2024-03-15", "S2", 2.5), ("2024-03-15", "S10", 10.0),
    ]
    last = frame.filter("value IS NOT NULL").groupBy("series_code").agg(F.max_by("value", "timestamp").alias("value"))
    assert [r["series_code"] for r in charts.yield_curve(last, tenors).collect()] == ["S2", "S10"]
    with pytest.raises(ValueError):
        charts.yield_curve(last, tenors, "maturity")


def test_spearman_ranks_without_a_window_over_a_pair(spark, long):
    rng = np.random.default_rng(4)
    x, y = rng.integers(-20, 20, 600), rng.integers(0, 300, 600)
    days = pd.date_range("2020-01-01", periods=600).strftime("%Y-%m-%d")
    rows = [(code, day, float(v)) for code, column in (("A", x), ("B", y), ("C", x * 0)) for day, v in zip(days, column)]
    frame = charts.correlation_matrix(long(rows), ["A", "B", "C"], "spearman")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    # Windows over rows are per range; the others see one row per range.
    assert "rank(" not in plan
    got = {(r.series_x, r.series_y): r.correlation for r in frame.collect()}
    want = round(float(np.corrcoef(pd.Series(x).rank(), pd.Series(y).rank())[0, 1]), 4)
    assert got == {("A", "A"): 1.0, ("B", "B"): 1.0, ("A", "B"): want, ("B", "A"): want}
