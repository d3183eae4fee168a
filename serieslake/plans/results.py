"""Result tables of fair-value runs: cross-sections, panels, saving, loading, daily digest."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.api import DataAPI
from serieslake.functions.numeric import to_level
from serieslake.plans.estimation import KEYS
from serieslake.plans.signals import NO_SIGNAL
from serieslake.schema import SEQ, SERIES_CODE, VERSION

GOLD = "gold"
ESTIMATES_TABLE = "fair_value_estimates"
SIGNALS_TABLE = "fair_value_signals"
ROWS_TABLE = "fair_value_rows"
SUMMARY_TABLE = "fair_value_summary"
PREFIXES = ("coefficient", "standard_error", "p_value")


def cross_section(signals: DataFrame) -> DataFrame:
    """One flat row per (pair, as_of): score, fair value, levels and every coefficient."""
    numbers = [c for c in signals.columns if c.startswith(tuple(f"{p}_" for p in PREFIXES))]
    return signals.filter(F.col("status") == "ok").select(
        *KEYS,
        "is_logged",
        "z_score",
        to_level(F.col("fitted_value"), F.col("is_logged")).alias("fair_value"),
        "dropped_variables",
        "cointegration_passed",
        F.col("target").alias("upper"),
        F.col("stop_loss").alias("lower"),
        F.lit(None).cast("string").alias("markov_state"),
        *numbers,
    )


def signal_rows(signals: DataFrame) -> DataFrame:
    """Signal table rows."""
    return signals.filter(F.col("status") == "ok").select(
        F.col("as_of").alias("date"),
        "universe",
        SERIES_CODE,
        "signal",
        F.col("z_score").alias("entry_z_score"),
        "target",
        "stop_loss",
        "reason",
    )


def estimate_rows(signals: DataFrame, drivers: Sequence[str]) -> DataFrame:
    """Estimate table rows."""
    return signals.filter(F.col("status") == "ok").select(
        F.col("as_of").alias("date"),
        "universe",
        SERIES_CODE,
        "is_logged",
        *[F.col(f"coefficient_{name}").alias(f"{name}_coef") for name in ("const", *drivers)],
        "fitted_value",
        "actual_value",
        "z_score",
        "r_squared",
        "n_obs",
        F.coalesce("cointegration_passed", F.lit(False)).alias("cointegration_passed"),
        (F.col("dropped_variables") != "").alias("sign_dropped"),
        F.nullif(F.col("dropped_variables"), F.lit("")).alias("dropped_variables"),
    )


def coefficients(summary: DataFrame) -> DataFrame:
    """Cross-section with coefficients, standard errors and p-values as maps by driver."""
    maps = []
    for prefix in PREFIXES:
        columns = [c for c in summary.columns if c.startswith(f"{prefix}_")]
        entries = F.create_map(
            *[x for c in columns for x in (F.lit(c[len(prefix) + 1 :]), F.col(c))]
        )
        maps.append(F.map_filter(entries, lambda _, v: v.isNotNull()).alias(f"{prefix}s"))
    return summary.select(*KEYS, *maps)


def panel(
    summary: DataFrame, field: str, codes: Sequence[str], *, sort: bool = True
) -> DataFrame:
    """Date by pair matrix of one scalar."""
    if field not in summary.columns:
        raise AttributeError(f"results have no field {field!r}")
    cells = [F.max(F.when(F.col(SERIES_CODE) == code, F.col(field))).alias(code) for code in codes]
    wide = summary.groupBy("as_of").agg(*cells)
    return wide.orderBy("as_of") if sort else wide


def z_scores(summary: DataFrame, z_threshold: float) -> DataFrame:
    """Scores in order, flagged where they reach the threshold."""
    z = F.col("z_score")
    flag = F.when(z >= z_threshold, "high").when(z <= -z_threshold, "low").otherwise("inside")
    return summary.select(*KEYS, "z_score", flag.alias("flag")).orderBy("z_score", SERIES_CODE)


def z_history(summary: DataFrame, codes: Sequence[str] | None = None) -> DataFrame:
    """Score per date and pair; needs more than one fitted date."""
    if summary.select("as_of").distinct().limit(2).count() < 2:
        raise ValueError("a score history needs more than one fitted date")
    rows = summary.select("as_of", SERIES_CODE, "z_score")
    return rows.filter(F.col(SERIES_CODE).isin(list(codes))) if codes is not None else rows


def latest_per_pair(summary: DataFrame, *order: str) -> DataFrame:
    """The newest row of each pair: latest as_of, then latest save."""
    ordering = [c for c in ("as_of", *order, VERSION, SEQ) if c in summary.columns]
    newest = F.max_by(F.struct(*summary.columns), F.struct(*ordering)).alias("r")
    return summary.groupBy(SERIES_CODE).agg(newest).select("r.*")


def latest_save(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of each key's newest commit, so a repeated save shows up once."""
    newest = rows.groupBy(*keys).agg(F.max(VERSION).alias("_newest"))
    return rows.join(newest, list(keys)).filter(F.col(VERSION) == F.col("_newest")).drop("_newest")


def save_results(api: DataAPI, summary: DataFrame, rows: DataFrame) -> None:
    """Write both result tables; a repeated run takes the place of the one before."""
    api.write_table(GOLD, ROWS_TABLE, rows, replace=["universe", "as_of"])
    api.write_table(GOLD, SUMMARY_TABLE, summary, replace=["universe", "as_of"])


def load_summary(
    api: DataAPI,
    *,
    series_code: str | None = None,
    universe: str | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """Newest saved cross-section rows, of the given date or of each pair's latest date."""
    table = api.lake.table(GOLD, SUMMARY_TABLE).read(bookkeeping=True)
    if not table.columns:
        raise LookupError("no saved results")
    for column, wanted in ((SERIES_CODE, series_code), ("universe", universe), ("as_of", as_of)):
        if wanted is not None:
            table = table.filter(F.col(column) == F.lit(wanted))
    return latest_per_pair(table).drop(VERSION, SEQ)


def load_rows(api: DataAPI, summary: DataFrame) -> DataFrame:
    """Windowed rows that belong to loaded cross-section rows."""
    table = api.lake.table(GOLD, ROWS_TABLE).read(bookkeeping=True)
    wanted = table.join(summary.select(SERIES_CODE, "as_of"), [SERIES_CODE, "as_of"], "left_semi")
    return latest_save(wanted, SERIES_CODE, "as_of").drop(VERSION, SEQ)


def run_counters(estimates: DataFrame) -> DataFrame:
    """Pairs, cointegrated pairs and sign drops per universe and date."""
    return estimates.groupBy("universe", "date").agg(
        F.count_distinct(SERIES_CODE).alias("pairs"),
        F.count_if("cointegration_passed").alias("passed"),
        F.count_if("sign_dropped").alias("sign_dropped"),
    )


def on_day(frame: DataFrame, day: Column) -> DataFrame:
    return frame.filter(F.to_date("date") == day)


def digest(estimates: DataFrame, signals: DataFrame, day: Column) -> DataFrame:
    """One row: failed cointegration tests, sign drops and live signals of a day."""
    counted = on_day(estimates, day).select(
        (~F.col("cointegration_passed")).cast("int").alias("failed"),
        F.col("sign_dropped").cast("int").alias("dropped"),
        F.lit(0).alias("live"),
    )
    fired = on_day(signals, day).select(
        F.lit(0).alias("failed"),
        F.lit(0).alias("dropped"),
        (F.col("signal") != NO_SIGNAL).cast("int").alias("live"),
    )
    totals = [
        F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
        for c, name in (
            ("failed", "cointegration_failures"),
            ("dropped", "sign_drops"),
            ("live", "new_signals"),
        )
    ]
    return counted.unionByName(fired).agg(*totals)


def check_rows(estimates: DataFrame, day: Column) -> DataFrame:
    """One row per check of a day: cointegration of every pair, and each sign drop."""
    pair = F.concat_ws("/", "universe", SERIES_CODE)
    passed = F.col("cointegration_passed")
    tested = F.struct(
        F.concat(pair, F.lit(": cointegration")).alias("label"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        F.when(~passed, F.lit("Engle-Granger test did not pass")).alias("note"),
    )
    dropped = F.when(
        F.col("sign_dropped"),
        F.struct(
            F.concat(pair, F.lit(": sign check")).alias("label"),
            F.lit("WARN").alias("status"),
            F.concat(
                F.lit("Dropped variable(s) with the wrong sign: "), F.col("dropped_variables")
            ).alias("note"),
        ),
    )
    entries = F.explode(F.array_compact(F.array(tested, dropped))).alias("c")
    return on_day(estimates, day).select(entries).select("c.*")


def signal_lines(signals: DataFrame, day: Column) -> DataFrame:
    """One line per pair of a day's signals."""
    return on_day(signals, day).select(
        F.concat_ws("/", "universe", SERIES_CODE).alias("name"),
        F.concat(
            F.lit("signal="),
            F.col("signal"),
            F.lit(", z="),
            F.format_string("%.2f", F.col("entry_z_score")),
            F.lit(", "),
            F.col("reason"),
        ).alias("line"),
        F.when(F.col("signal") != NO_SIGNAL, "OK").otherwise("—").alias("status"),
    )
