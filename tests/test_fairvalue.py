from __future__ import annotations

import math
from dataclasses import replace
from datetime import date

import numpy as np
import pandas as pd
import pytest
from conftest import records
from pyspark.sql import functions as F

from serieslake.api import DataAPI
from serieslake.operators.quality import drop_failing
from serieslake.plans import discovery, drivers, estimation, model, regression, results, signals
from serieslake.plans import sweep, unitroot
from serieslake.plans.universes import (
    BUY_SELL_SERIES,
    CHINA_DRIVERS,
    DRIVERS,
    FX_CHN,
    FX_EM,
    FX_G10,
    OFFSHORE_SERIES,
    ONSHORE_SERIES,
    TURNOVER_SERIES,
    UNIVERSES,
    Universe,
)
from serieslake.schema import InsufficientDataError

# -- numbers -------------------------------------------------------------------------------


def test_least_squares_matches_numpy():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 3))
    y = 1.5 + x @ [1.0, -2.0, 0.5] + rng.normal(size=80)
    fit = regression.least_squares(y, x)
    design = np.column_stack([np.ones(80), x])
    beta, sse, _, _ = np.linalg.lstsq(design, y, rcond=None)
    assert np.allclose(fit.beta, beta) and fit.sse == pytest.approx(sse[0])
    errors = np.sqrt(sse[0] / 76 * np.diag(np.linalg.inv(design.T @ design)))
    assert np.allclose(fit.standard_errors(), errors)


@pytest.mark.parametrize("seed", [11, 23, 58, 90])
def test_repeated_columns_share_their_weight(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(350, 2))
    fit = regression.least_squares(2 * x[:, 0] + rng.normal(size=350), np.column_stack([x, x[:, 0]]))
    assert fit.beta[1] == pytest.approx(fit.beta[3], rel=1e-6)


def test_student_tail_against_known_points():
    # Two-sided 5 % points of published t tables.
    for df, point in ((1, 12.706), (5, 2.571), (10, 2.228), (30, 2.042), (120, 1.980)):
        assert regression.student_two_sided(point, df) == pytest.approx(0.05, abs=2e-4)
    assert regression.student_two_sided(0.0, 10) == pytest.approx(1.0)
    assert math.isnan(regression.student_two_sided(math.nan, 10))


def test_unit_root_tables():
    # Asymptotic critical values and the p-values at them.
    for level, point, p in (("1%", -3.43, 0.01), ("5%", -2.86, 0.05), ("10%", -2.57, 0.10)):
        assert regression.critical_value(level, 10**9) == pytest.approx(point, abs=0.005)
        assert regression.unit_root_p_value(point) == pytest.approx(p, abs=0.003)
    assert regression.unit_root_p_value(-50) == 0.0 and regression.unit_root_p_value(3) == 1.0
    near = regression.TAU_SPLIT
    assert regression.unit_root_p_value(near) == pytest.approx(regression.unit_root_p_value(near + 1e-9), abs=0.01)


def brute_unit_root(x):
    """Textbook test: every lag fitted by itself on the common sample."""
    n0 = len(x)
    longest = min(math.ceil(12 * (n0 / 100) ** 0.25), n0 // 2 - 2)
    d = np.diff(x)

    def ols(lags, start):
        rows = range(start, len(d))
        design = np.array([[1.0, x[t], *[d[t - i] for i in range(1, lags + 1)]] for t in rows])
        y = d[start:]
        beta, *_ = np.linalg.lstsq(design, y, rcond=None)
        e = y - design @ beta
        return beta, e @ e, design, len(y)

    def bic(lags):
        _, sse, design, n = ols(lags, longest)
        return n * math.log(sse / n) + math.log(n) * design.shape[1]

    lags = min(range(longest + 1), key=bic)
    beta, sse, design, n = ols(lags, lags)
    error = math.sqrt(sse / (n - design.shape[1]) * np.linalg.inv(design.T @ design)[1, 1])
    return beta[1] / error, lags, n


@pytest.mark.parametrize("seed", range(4))
def test_unit_root_statistic_matches_brute_force(seed):
    rng = np.random.default_rng(seed)
    noise = rng.normal(size=250)
    series = noise.cumsum() if seed % 2 else np.convolve(noise, [1, 0.6, 0.3], "same")
    ours = regression.unit_root_test(series)
    statistic, lags, n = brute_unit_root(series)
    assert (ours.lags, ours.n) == (lags, n) and ours.statistic == pytest.approx(statistic)


def test_constant_series_has_no_statistic():
    assert math.isnan(regression.unit_root_test(np.ones(50)).statistic)


# -- configuration -------------------------------------------------------------------------


def test_universe_parameters():
    assert [(u.window_months, u.stop_reward_ratio, u.logged_rate_threshold, u.cointegration_significance, u.min_observations) for u in UNIVERSES.values()] == [
        (12, 2.0, 0.01, 0.05, 60), (6, 1.0, 0.0025, 0.05, 60), (6, 1.0, 0.0025, 0.01, 60),
    ]
    assert replace(FX_G10, z_threshold=2.0).z_threshold == 2.0 and FX_G10.z_threshold == 1.5


@pytest.mark.parametrize(
    "change",
    [
        {"name": "G20"}, {"window_months": 0}, {"z_threshold": -1}, {"cointegration_significance": 1},
        {"expected_signs": {"commodity": 1}}, {"expected_signs": {**FX_CHN.expected_signs}},
        {"expected_signs": {**FX_G10.expected_signs, "commodity": 2}},
    ],
)
def test_bad_parameters(change):
    with pytest.raises(ValueError):
        replace(FX_G10, **change)


# -- regression panels ---------------------------------------------------------------------


PANEL_DAYS = 430


def panel(n=PANEL_DAYS, seed=0, names=DRIVERS):
    """Random-walk drivers and a rate that follows them."""
    rng = np.random.default_rng(1000 + seed)
    days = pd.bdate_range("2022-09-05", periods=n)
    x = pd.DataFrame(rng.normal(0, 0.13, (n, len(names))).cumsum(axis=0), index=days, columns=list(names))
    weights = [0.72, -0.41, 0.27, 0.16, 0.09, 0.05, -0.03][: len(names)]
    x["rate"] = 2.4 + x[list(names)].to_numpy() @ weights + rng.normal(0, 0.017, n)
    return x


def as_features(spark, frame, universe="G10", code="P", is_logged=False, extra=()):
    columns = ["rate", *CHINA_DRIVERS]
    rows = [
        (code, universe, day.date(), *[None if c not in frame or math.isnan(row[c]) else float(row[c]) for c in columns], bool(is_logged))
        for day, row in frame.iterrows()
    ]
    schema = "series_code string, universe string, day date, " + ", ".join(f"{c} double" for c in columns) + ", is_logged boolean"
    return spark.createDataFrame(rows, schema)


def expected_fit(frame, as_of, months, names, is_logged=False):
    start = pd.Timestamp(as_of) - pd.DateOffset(months=months)
    rows = frame[(frame.index > start) & (frame.index <= pd.Timestamp(as_of))][["rate", *names]].dropna()
    y = np.log(rows["rate"]) if is_logged else rows["rate"]
    design = np.column_stack([np.ones(len(rows)), rows[list(names)]])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    residual = y.to_numpy() - design @ beta
    return beta, residual, rows


def test_estimate_matches_row_level_least_squares(spark):
    frame = panel(seed=3)
    as_of = frame.index[-10].date()
    out = estimation.estimate(as_features(spark, frame), FX_G10, fit_dates=[as_of]).first()
    beta, residual, rows = expected_fit(frame, as_of, 12, DRIVERS)
    assert out["status"] == "ok" and out["n_obs"] == len(rows) and out["dropped_variables"] == ""
    assert [out[f"coefficient_{n}"] for n in ("const", *DRIVERS)] == pytest.approx(beta)
    assert out["residual_std"] == pytest.approx(residual.std())
    assert out["z_score"] == pytest.approx(residual[-1] / residual.std())
    assert out["r_squared"] > 0.9 and out["cointegration_passed"]
    assert out["coefficient_interest_rate_differential"] == pytest.approx(0.72, abs=0.1)


def test_later_rows_do_not_change_an_estimate(spark):
    frame = panel(seed=4)
    as_of = frame.index[300].date()
    before = estimation.estimate(as_features(spark, frame[:301]), FX_G10, fit_dates=[as_of])
    corrupted = frame.copy()
    corrupted.iloc[301:] *= 1000
    after = estimation.estimate(as_features(spark, corrupted), FX_G10, fit_dates=[as_of])
    assert before.collect() == after.collect()


def test_wrong_signs_are_dropped_once_and_rows_reenter(spark):
    frame = panel(seed=5)
    frame["rate"] = frame["rate"] - 2 * 0.27 * frame["local_equity"]
    frame.iloc[200:260, frame.columns.get_loc("local_equity")] = np.nan
    as_of = frame.index[-1].date()
    out = estimation.estimate(as_features(spark, frame), FX_G10, fit_dates=[as_of]).first()
    kept = [name for name in DRIVERS if name not in out["dropped_variables"].split(",")]
    beta, residual, rows = expected_fit(frame, as_of, 12, kept)
    assert "local_equity" in out["dropped_variables"] and out["coefficient_local_equity"] is None
    assert out["n_obs"] == len(rows)
    assert [out[f"coefficient_{n}"] for n in ("const", *kept)] == pytest.approx(beta)
    assert out["cointegration_n_obs"] == len(expected_fit(frame, as_of, 12, DRIVERS)[2])


def test_log_regime_and_standard_errors(spark):
    frame = panel(seed=6)
    frame["rate"] = np.exp(frame["rate"])
    as_of = frame.index[-1].date()
    out = estimation.estimate(as_features(spark, frame, is_logged=True), FX_G10, fit_dates=[as_of]).first()
    beta, residual, rows = expected_fit(frame, as_of, 12, DRIVERS, is_logged=True)
    assert [out[f"coefficient_{n}"] for n in ("const", *DRIVERS)] == pytest.approx(beta)
    design = np.column_stack([np.ones(len(rows)), rows[list(DRIVERS)]])
    errors = np.sqrt(residual @ residual / (len(rows) - 6) * np.diag(np.linalg.inv(design.T @ design)))
    assert [out[f"standard_error_{n}"] for n in ("const", *DRIVERS)] == pytest.approx(errors)
    assert 0 <= out["p_value_commodity"] <= 1


def test_short_history_is_reported_not_raised(spark):
    frame = panel(n=50)
    out = estimation.estimate(as_features(spark, frame), FX_G10).first()
    assert out["status"] == "insufficient_data" and out["cointegration_passed"] is False
    every_sign_wrong = replace(FX_G10, expected_signs={k: -v for k, v in FX_G10.expected_signs.items()})
    out = estimation.estimate(as_features(spark, panel(seed=3)), every_sign_wrong).first()
    assert out["status"] == "insufficient_data"


def test_fitted_rows_reproduce_the_fit(spark):
    frame = panel(seed=7)
    features = as_features(spark, frame)
    as_of = frame.index[-1].date()
    estimates = estimation.estimate(features, FX_G10, fit_dates=[as_of])
    rows = estimation.fitted_rows(features, estimates, FX_G10, fit_dates=[as_of]).orderBy("date").collect()
    first = estimates.first()
    assert len(rows) == first["n_obs"] and rows[-1]["fitted"] == pytest.approx(first["fitted_value"])
    assert sum(r["residual"] for r in rows) == pytest.approx(0, abs=1e-8)
    assert rows[0]["upper_bound"] - rows[0]["lower_bound"] == pytest.approx(3 * first["residual_std"])
    design = estimation.design_rows(features, estimates, FX_G10, fit_dates=[as_of])
    assert design.filter("const = 1.0").count() == len(rows)


def test_moments_agree_with_rows(spark):
    frame = panel(seed=8)
    features = as_features(spark, frame)
    rolled = estimation.rolling_moments(features, ["series_code"], "rate", list(DRIVERS), 12)
    solved = estimation.solve_moments(rolled, "rate", list(DRIVERS), min_observations=60)
    got = {r["day"]: r for r in solved.collect()}
    assert len(got) == PANEL_DAYS - 59
    for day in (frame.index[70], frame.index[255], frame.index[-1]):
        beta, residual, rows = expected_fit(frame, day, 12, DRIVERS)
        row = got[day.date()]
        assert row["n"] == len(rows)
        assert [row[f"coefficient_{n}"] for n in ("const", *DRIVERS)] == pytest.approx(beta, rel=1e-6, abs=1e-9)
        assert row["residual_std"] == pytest.approx(residual.std(), rel=1e-6)


def test_month_key_equals_clamped_month_arithmetic(spark):
    days = [d.date() for d in pd.date_range("2023-01-25", "2024-03-05")]
    frame = spark.createDataFrame([(d,) for d in days], "d date")
    pairs = frame.crossJoin(frame.withColumnRenamed("d", "a")).select(
        (estimation.month_key(F.col("d")) > estimation.month_key(F.col("a")) - 96).alias("by_key"),
        (F.col("d") > F.add_months("a", -3)).alias("by_month"),
    )
    assert pairs.filter("by_key <> by_month").count() == 0


def test_pairwise_cointegration(spark):
    frame = panel(seed=9)
    frame["independent"] = np.random.default_rng(1).normal(size=PANEL_DAYS).cumsum()
    rows = [("P", d.date(), float(r["rate"]), float(r["rate"] * 2 + e)) for (d, r), e in zip(frame.iterrows(), np.random.default_rng(2).normal(0, 0.01, PANEL_DAYS))]
    both = spark.createDataFrame(rows, "series_code string, day date, y double, x double")
    out = estimation.pairwise_cointegration(both, "y", "x", keys=["series_code"], as_of=date(2024, 1, 1)).first()
    assert out["passed"] and out["n_obs"] == (frame.index <= "2024-01-01").sum()
    short = estimation.pairwise_cointegration(both, "y", "x", keys=["series_code"], as_of=date(2022, 9, 20)).first()
    assert short["status"] == "insufficient_data"


# -- signals -------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "z, p, logged, signal, target, stop, reason",
    [
        (5.0, 0.5, False, "NONE", None, None, "cointegration failed (p=0.5000)"),
        (0.5, 0.01, False, "NONE", None, None, "|z|=0.50 below threshold 1.5"),
        (2.0, 0.01, False, "SELL", 1.10, 1.15, "|z|=2.00 >= threshold 1.5, cointegrated"),
        (-2.0, 0.01, False, "BUY", 1.10, 1.11, "|z|=2.00 >= threshold 1.5, cointegrated"),
        (2.0, 0.01, True, "SELL", math.exp(1.10), None, "|z|=2.00 >= threshold 1.5, cointegrated"),
    ],
)
def test_signal_rules(spark, z, p, logged, signal, target, stop, reason):
    rate = 1.13 if signal != "BUY" else 1.12
    rows = [("P", "G10", date(2024, 6, 3), "ok", logged, z, 1.10, rate, p <= 0.05, p)]
    names = "series_code string, universe string, as_of date, status string, is_logged boolean, z_score double, fitted_value double, current_rate double, cointegration_passed boolean, cointegration_p_value double"
    frame = spark.createDataFrame(rows, names)
    out = signals.with_signals(frame, z_threshold=1.5, stop_reward_ratio=2.0).first()
    assert (out["signal"], out["reason"]) == (signal, reason)
    assert out["target"] == (None if target is None else pytest.approx(target))
    if stop is not None and signal == "SELL":
        assert out["stop_loss"] == pytest.approx(rate + abs(rate - target) / 2)
    if signal == "BUY":
        assert out["stop_loss"] == pytest.approx(rate - abs(rate - target) / 2)


# -- discovery -----------------------------------------------------------------------------

ROLE_ROWS = {
    "swap_2y": ("Interest Rate Swap", "2Y", None),
    "rate_3m": ("Money Market Rate", "3M", None),
    "yield_10y": ("Sovereign Yield", "10Y", None),
    "cds_5y": ("Sovereign CDS", "5Y", None),
    "local_equity": ("Equity Index", None, "Local"),
}
CATALOG = "series_code string, asset_class string, sub_asset_class string, market_development string, currency string, tenor string, market_segment string, is_synthetic string, valid_to string"


def pair_row(code, universe):
    return (code, "Currency", "FX Spot", universe, code[:3], None, None, "False", None)


def role_rows(currency, *missing):
    return [
        (f"{currency}_{role}", "Driver", sub, None, currency, tenor, segment, "False", None)
        for role, (sub, tenor, segment) in ROLE_ROWS.items()
        if role not in missing
    ]


def world(spark):
    rows = [pair_row("EURUSD_PX_LAST", "G10"), pair_row("EURGBP_PX_LAST", "G10"), pair_row("USDZAR_PX_LAST", "EM"),
            pair_row("TRYZAR_PX_LAST", "EM"), pair_row("GOLD", "G10"), pair_row("USDCNH_PX_LAST", "CHN")]
    rows += role_rows("USD") + role_rows("EUR") + role_rows("GBP", "yield_10y") + role_rows("ZAR") + role_rows("CNH", "local_equity")
    rows += [
        ("CNHMSCI", "Driver", "Equity Index", None, "CNH", None, "Local", "True", None),
        ("CNHZLIVE", "Driver", "Equity Index", None, "CNH", None, "Local", "False", None),
    ]
    rows += [(code, "Flows", "Flow", "CHN", "CNH", None, None, "False", "2024-08-16") for code in BUY_SELL_SERIES.values()]
    return spark.createDataFrame(rows, CATALOG)


def test_availability(spark):
    catalog = world(spark)
    report = {r["series_code"]: r for r in discovery.availability_report(discovery.discover_pairs(catalog), catalog).collect()}
    assert not report["EURUSD_PX_LAST"]["blocked"] and report["EURUSD_PX_LAST"]["quote_swap_2y"] == "USD_swap_2y"
    assert report["EURGBP_PX_LAST"]["block_reasons"] == "No yield_10y series for GBP."
    assert report["TRYZAR_PX_LAST"]["block_reasons"] == discovery.NO_USD_LEG
    assert report["GOLD"]["block_reasons"] == "Could not parse currency legs from series_code 'GOLD'."
    assert report["USDZAR_PX_LAST"]["quote_cds_5y"] == "ZAR_cds_5y" and report["USDZAR_PX_LAST"]["base_cds_5y"] is None
    assert report["USDCNH_PX_LAST"]["quote_local_equity"] == "CNHZLIVE"
    only = discovery.discover_pairs(catalog, "EM", require_real=True)
    assert records(only, "series_code") == [("TRYZAR_PX_LAST",), ("USDZAR_PX_LAST",)]
    odd = spark.createDataFrame([("EURUSD_X", "G20")], "series_code string, universe string")
    assert discovery.availability_report(odd, catalog).first()["block_reasons"] == "Unknown universe 'G20'."


def test_roles_without_their_columns_match_nothing(spark):
    catalog = world(spark).drop("market_segment", "is_synthetic")
    assert "local_equity" not in [r[0] for r in records(discovery.role_index(catalog), "role")]


def test_report_round_trip(spark):
    catalog = world(spark)
    report = discovery.availability_report(discovery.discover_pairs(catalog, "EM"), catalog)
    roles = records(discovery.report_roles(report).filter("series_code = 'USDZAR_PX_LAST'"), "leg", "role", "role_code")
    assert ("quote", "cds_5y", "ZAR_cds_5y") in roles and len(roles) == 5


def test_cutover(spark):
    catalog = world(spark)
    assert drivers.flows_cutover(catalog) == date(2024, 8, 16)
    with pytest.raises(ValueError):
        drivers.flows_cutover(catalog.withColumn("valid_to", F.lit(None).cast("string")))


# -- whole runs ----------------------------------------------------------------------------


def market(spark, seed=0, n=400):
    """Random-walk inputs; the rand rate depends on its drivers, so its fit is good."""
    rng = np.random.default_rng(seed)
    days = pd.bdate_range("2023-01-02", periods=n)
    codes = [f"{c}_{r}" for c in ("USD", "EUR", "GBP", "ZAR", "CNH") for r in ROLE_ROWS]
    codes += ["MXWO_PX_LAST", "BRENT_PX_LAST", OFFSHORE_SERIES, ONSHORE_SERIES, "CNHZLIVE", "EURUSD_PX_LAST", "USDCNH_PX_LAST"]
    codes += [*BUY_SELL_SERIES.values(), *TURNOVER_SERIES.values()]
    wide = pd.DataFrame(100 + rng.normal(0, 0.5, (n, len(codes))).cumsum(axis=0), index=days, columns=codes)
    wide["USDZAR_PX_LAST"] = (
        18 + 0.5 * (wide["USD_swap_2y"] - wide["ZAR_swap_2y"]) - 0.02 * wide["ZAR_cds_5y"]
        + 0.5 * np.log(wide["ZAR_local_equity"]) + rng.normal(0, 0.05, n)
    )
    long = wide.stack().reset_index()
    long.columns = ["timestamp", "series_code", "value"]
    return wide, spark.createDataFrame(long[["series_code", "timestamp", "value"]]).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


def test_fit_em(spark):
    wide, values = market(spark)
    fitted = model.fit(world(spark), values, FX_EM, lookback_days=3, cointegration=model.EACH)
    assert len(fitted.fit_dates) == 3 and fitted.resolve(-1) == wide.index[-1].date()
    assert records(fitted.blocked, "series_code") == [("TRYZAR_PX_LAST",)]
    row = fitted.get_cross_section().first()
    frame = pd.DataFrame(
        {
            "rate": wide["USDZAR_PX_LAST"], "interest_rate_differential": wide["USD_swap_2y"] - wide["ZAR_swap_2y"],
            "yield_curve_or_cds": wide["ZAR_cds_5y"], "local_equity": np.log(wide["ZAR_local_equity"]),
            "global_equity": np.log(wide["MXWO_PX_LAST"]), "commodity": np.log(wide["BRENT_PX_LAST"]),
        }
    )
    kept = [d for d in DRIVERS if d not in row["dropped_variables"].split(",")]
    beta, residual, _ = expected_fit(frame, wide.index[-1], 6, kept, row["is_logged"])
    assert [row[f"coefficient_{n}"] for n in ("const", *kept)] == pytest.approx(beta, rel=1e-6)
    assert row["z_score"] == pytest.approx(residual[-1] / residual.std(), rel=1e-6)
    assert fitted.panel("z_score").count() == 3
    assert fitted.get("USDZAR_PX_LAST").count() == fitted.signals.orderBy(F.desc("as_of")).first()["n_obs"]
    with pytest.raises(KeyError):
        fitted.resolve("1999-01-01")
    with pytest.raises(AttributeError):
        fitted.panel("nonsense")


def test_latest_mode_applies_one_verdict(spark):
    _, values = market(spark)
    each = model.fit(world(spark), values, FX_EM, lookback_days=2, cointegration=model.EACH).signals
    latest = model.fit(world(spark), values, FX_EM, lookback_days=2).signals
    newest = each.orderBy(F.desc("as_of")).first()
    verdicts = {r["cointegration_statistic"] for r in latest.collect()}
    assert verdicts == {newest["cointegration_statistic"]}
    with pytest.raises(ValueError):
        model.fit(world(spark), values, FX_EM, cointegration="sometimes")
    with pytest.raises(InsufficientDataError):
        model.fit(world(spark), values, FX_EM, as_of="1990-01-01")


def test_china_has_seven_drivers_and_two_flow_regimes(spark):
    wide, values = market(spark)
    catalog = world(spark)
    catalog = catalog.withColumn("valid_to", F.when(F.col("valid_to").isNotNull(), "2023-06-01"))
    _, features = model.pair_features(catalog, values, FX_CHN)
    by_day = {r["day"]: r for r in features.collect()}
    net = sum(wide[BUY_SELL_SERIES[k]] * s for k, s in (("shanghai_buy", 1), ("shenzhen_buy", 1), ("shanghai_sell", -1), ("shenzhen_sell", -1)))
    turnover = sum(wide[c] for c in TURNOVER_SERIES.values())
    before, after = pd.Timestamp("2023-05-31"), pd.Timestamp("2023-06-01")
    keyed = {pd.Timestamp(k): v for k, v in by_day.items()}
    assert keyed[before]["flows"] == pytest.approx(net[before])
    assert keyed[after]["flows"] == pytest.approx(turnover[after])
    assert keyed[after]["offshore_spread"] == pytest.approx(wide.loc[after, OFFSHORE_SERIES] - wide.loc[after, ONSHORE_SERIES])
    without_one = values.filter(F.col("series_code") != "SHANGHAI_FLOWS_TURNOVER_PX_LAST")
    _, features = model.pair_features(catalog, without_one, FX_CHN)
    assert features.filter("flows IS NOT NULL").count() == 0
    fitted = model.fit(catalog, values, FX_CHN)
    assert "coefficient_flows" in fitted.summary.columns and fitted.summary.count() == 1


def test_save_load_and_daily_run(spark, tmp_path):
    _, values = market(spark)
    api = DataAPI(spark, str(tmp_path))
    api.import_metadata(world(spark))
    api.write_values(values, ticker_source="bloomberg")
    fitted = model.FairValueModel.from_api(api, "EM").fit(lookback_days=2)
    fitted.save(api)
    fitted.save(api)
    other = model.FairValueModel.from_api(api, FX_CHN).fit()
    other.save(api)
    loaded = results.load_summary(api, series_code="USDZAR_PX_LAST").first()
    assert loaded["as_of"] == fitted.resolve() and loaded["coefficient_flows"] is None
    rows = results.load_rows(api, results.load_summary(api, universe="EM"))
    assert rows.count() == fitted.get("USDZAR_PX_LAST").count()
    earlier = results.load_summary(api, universe="EM", as_of=fitted.resolve(0)).first()
    assert earlier["as_of"] == fitted.resolve(0)
    assert results.load_summary(api, series_code="NONE").count() == 0
    maps = results.coefficients(results.load_summary(api, universe="EM")).first()
    assert "flows" not in maps["coefficients"] and "const" in maps["standard_errors"]

    outcome = model.run_daily(api, FX_EM, as_of=fitted.resolve())
    assert (outcome["pairs"], outcome["blocked"], outcome["written"]) == (2, 1, 1)
    saved = api.read_table(results.GOLD, results.ESTIMATES_TABLE).frame.first()
    direct = fitted.get_cross_section().first()
    assert saved["z_score"] == pytest.approx(direct["z_score"])
    assert outcome["stale_pairs"] == {}
    stale = model.run_daily(api, FX_EM, as_of="2030-01-01")
    assert stale["written"] == 0 and list(stale["stale_pairs"]) == ["USDZAR_PX_LAST"]
    assert f"newest rate {fitted.resolve()}" in stale["stale_pairs"]["USDZAR_PX_LAST"]


def test_features_schema_failures_drop_only_that_pair(spark):
    frame = panel()
    good = as_features(spark, frame, code="GOOD").withColumn("realized_volatility", F.lit(0.1))
    bad = as_features(spark, frame.assign(rate=-1.0), code="BAD").withColumn("realized_volatility", F.lit(0.1))
    rows = drop_failing(good.union(bad), ["series_code"], drivers.feature_rules())
    assert records(rows.select("series_code").distinct()) == [("GOOD",)]


def test_universe_is_plain_data():
    assert isinstance(FX_G10, Universe) and FX_CHN.drivers == CHINA_DRIVERS


def row_level(frame, universe, as_of):
    """A fit from its rows: sign check, refit on the rows its drivers allow."""
    names = list(universe.drivers)
    start = pd.Timestamp(as_of) - pd.DateOffset(months=universe.window_months)
    rows = frame[(frame.index > start) & (frame.index <= pd.Timestamp(as_of))]
    rate = rows["rate"].where(rows["rate"] > 0) if rows["flag"].iloc[-1] else rows["rate"]
    y = np.log(rate) if rows["flag"].iloc[-1] else rate

    def solve(kept):
        used = y.notna() & rows[kept].notna().all(axis=1)
        if used.sum() < universe.min_observations:
            return None
        return regression.least_squares(y[used].to_numpy(), rows.loc[used, kept].to_numpy()), y[used].to_numpy()

    first = solve(names)
    if first is None:
        return {"status": "insufficient_data"}
    slopes = first[0].beta[1:]
    kept = [n for n, b in zip(names, slopes) if not b * universe.expected_signs[n] < 0]
    final = solve(kept) if kept else None
    if final is None:
        return {"status": "insufficient_data", "residuals": first[0].residuals}
    fit, seen = final
    out = {
        "status": "ok", "n_obs": fit.n, "dropped_variables": ",".join(n for n in names if n not in kept),
        "fitted_value": fit.fitted[-1], "actual_value": seen[-1], "residual_std": np.sqrt(fit.sse / fit.n),
        "z_score": fit.residuals[-1] / np.sqrt(fit.sse / fit.n),
        "r_squared": 1 - fit.sse / ((seen - seen.mean()) ** 2).sum(), "residuals": first[0].residuals,
    }
    for prefix, numbers in (("coefficient", fit.beta), ("standard_error", fit.standard_errors()), ("p_value", fit.p_values())):
        out |= {f"{prefix}_{n}": v for n, v in zip(["const", *kept], numbers)}
    return out


def same_fit(row, wanted):
    for name, value in wanted.items():
        if name == "residuals":
            root = regression.unit_root_test(value)
            assert row["cointegration_statistic"] == pytest.approx(root.statistic, rel=1e-6)
            assert row["cointegration_p_value"] == pytest.approx(root.p_value, rel=1e-5, abs=1e-9)
            assert row["cointegration_n_obs"] == len(value)
            assert row["critical_5pct"] == pytest.approx(regression.critical_value("5%", root.n))
        else:
            close = pytest.approx(value, rel=1e-6, abs=1e-9) if isinstance(value, float) else value
            assert row[name] == close, name


@pytest.mark.parametrize("universe, gaps, logged", [(FX_EM, False, False), (FX_EM, True, False), (FX_EM, True, True), (FX_CHN, True, True)])
def test_fits_equal_the_row_level(spark, universe, gaps, logged):
    """Windows as differences, sweeps and lagged products against rows, on every day."""
    frame = panel(seed=11, names=universe.drivers)
    frame["rate"] = np.exp(frame["rate"]) - 0.3 * frame["commodity"] - (1.5 if logged else 0)
    rng = np.random.default_rng(5)
    if gaps:
        for name in ("commodity", "local_equity", "yield_curve_or_cds"):
            frame.loc[rng.random(len(frame)) < 0.1, name] = np.nan
        frame.loc[rng.random(len(frame)) < 0.05, "rate"] = np.nan
    frame["flag"] = [logged or day.day % 2 == 0 for day in frame.index]
    features = as_features(spark, frame, universe=universe.name)
    if not logged:
        features = features.withColumn("is_logged", F.dayofmonth("day") % 2 == 0)
    else:
        features = features.withColumn("is_logged", F.lit(True))
    days = [frame.index[i].date() for i in range(40, 400, 7)]
    some = {r["as_of"]: r for r in estimation.estimate(features, universe, fit_dates=days).collect()}
    every = estimation.estimate(features, universe, every_day=True, test_dates=[]).collect()
    assert len(every) == PANEL_DAYS
    every = {r["as_of"]: r for r in every}
    for day in days:
        wanted = row_level(frame, universe, day)
        same_fit(some[day], wanted)
        assert every[day]["cointegration_passed"] is None
        same_fit(every[day], {k: v for k, v in wanted.items() if k != "residuals"})


def test_repeated_and_still_drivers(spark):
    """A driver that repeats another shares its weight; one that does not move has none."""
    frame = panel(seed=13)
    frame["rate"] = frame["rate"] + 0.3 * frame["interest_rate_differential"]
    frame["global_equity"], frame["commodity"] = frame["interest_rate_differential"], 7.0
    features = as_features(spark, frame)
    out = estimation.estimate(features, FX_G10, fit_dates=[frame.index[-1].date()]).first()
    wanted = row_level(frame.assign(flag=False), replace(FX_G10, drivers=DRIVERS), frame.index[-1])
    assert out["coefficient_interest_rate_differential"] == pytest.approx(out["coefficient_global_equity"], rel=1e-4)
    assert out["fitted_value"] == pytest.approx(wanted["fitted_value"], rel=1e-6)
    assert out["coefficient_commodity"] == 0.0 and out["residual_std"] == pytest.approx(wanted["residual_std"], rel=1e-6)


def test_sweeps_invert_and_solve(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 4))
    gram = x.T @ x
    rows = spark.createDataFrame([(gram.tolist(),)], "m array<array<double>>")
    places = F.array(*[F.lit(k) for k in range(3)])
    spread = F.array(*[F.lit(float(v)) for v in np.diag(gram)])
    got = np.array(rows.select(sweep.swept_over(F.col("m"), places, spread)["m"].alias("m")).first()["m"])
    inverse = np.linalg.inv(gram[:3, :3])
    assert np.allclose(got[:3, :3], inverse) and np.allclose(got[:3, 3], inverse @ gram[:3, 3])
    assert got[3, 3] == pytest.approx(gram[3, 3] - gram[3, :3] @ inverse @ gram[:3, 3])


def test_student_tail_in_expressions(spark):
    points = [(t, df) for df in (1, 2, 3, 8, 61, 240) for t in (-4.0, 0.0, 0.3, 2.0, 9.0)]
    rows = spark.createDataFrame(points, "t double, df int")
    for row in rows.select("t", "df", sweep.student_tail(F.col("t"), F.col("df")).alias("p")).collect():
        assert row["p"] == pytest.approx(regression.student_two_sided(row["t"], row["df"]), abs=1e-12)


@pytest.mark.parametrize("seed", range(3))
def test_lagged_moments_match_brute_force(seed):
    rng = np.random.default_rng(seed)
    cells = np.column_stack([np.ones(500), rng.normal(size=(500, 3)).cumsum(axis=0)])
    weights = np.column_stack([rng.normal(size=6), np.ones(6), rng.normal(size=(6, 2))])
    start, stop = np.array([0, 0, 30, 100, 150, 470]), np.array([60, 200, 290, 400, 500, 500])
    found = unitroot.LaggedMoments(cells).tests(weights, start, stop)
    for k, row in found.iterrows():
        statistic, lags, n = brute_unit_root((cells @ weights[k])[start[k] : stop[k]])
        assert (row["lags"], row["n"]) == (lags, n) and row["statistic"] == pytest.approx(statistic, rel=1e-6)
