"""From availability to driver features: series mapping, formulas, grid, volatility regime."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.functions.dates import parse_timestamp
from serieslake.functions.numeric import is_finite, log_level
from serieslake.functions.text import non_usd_leg
from serieslake.operators.periods import conform_to_business_days, daily_last
from serieslake.operators.quality import Rule, freshness, out_of_range
from serieslake.operators.rolling import realized_volatility
from serieslake.operators.values import select_codes
from serieslake.plans.universes import (
    BUY_SELL_SERIES,
    CHINA_DRIVERS,
    CHN,
    COMMODITY_SERIES,
    G10,
    GLOBAL_EQUITY_SERIES,
    OFFSHORE_SERIES,
    ONSHORE_SERIES,
    TURNOVER_SERIES,
    UNIVERSES,
    Universe,
)
from serieslake.schema import SERIES_CODE, TIMESTAMP, VALUE
from serieslake.session import cut_lineage

RATE = "rate"
SOURCE_CODE = "source_code"
FLOWS = {**BUY_SELL_SERIES, **TURNOVER_SERIES}
SLOTS = (
    RATE,
    "world_equity",
    "oil",
    "base_swap",
    "quote_swap",
    "base_3m",
    "quote_3m",
    "base_10y",
    "quote_10y",
    "base_equity",
    "quote_equity",
    "cds",
    "equity",
    "offshore",
    "onshore",
    *FLOWS,
)
# Plausible range of a currency rate.
RATE_RANGE = (1e-4, 1e5)


def series_mapping(report: DataFrame) -> DataFrame:
    """(series_code, universe, slot, source_code): every series a pair's drivers read.

    Inputs that only make sense together (both swaps, all four curve points, both equity
    indices) are listed only when all of them are available.
    """
    leg = non_usd_leg(F.col("base_currency"), F.col("quote_currency"))

    def of_leg(role: str) -> Column:
        return F.when(leg == "base", F.col(f"base_{role}")).when(
            leg == "quote", F.col(f"quote_{role}")
        )

    is_g10 = F.col("universe") == G10
    is_chn = F.col("universe") == CHN
    swaps = F.col("base_swap_2y").isNotNull() & F.col("quote_swap_2y").isNotNull()
    curve = is_g10
    for name in ("base_rate_3m", "quote_rate_3m", "base_yield_10y", "quote_yield_10y"):
        curve = curve & F.col(name).isNotNull()
    equities = is_g10 & (
        F.col("base_local_equity").isNotNull() & F.col("quote_local_equity").isNotNull()
    )
    sources = {
        RATE: F.col(SERIES_CODE),
        "world_equity": F.lit(GLOBAL_EQUITY_SERIES),
        "oil": F.lit(COMMODITY_SERIES),
        "base_swap": F.when(swaps, F.col("base_swap_2y")),
        "quote_swap": F.when(swaps, F.col("quote_swap_2y")),
        "base_3m": F.when(curve, F.col("base_rate_3m")),
        "quote_3m": F.when(curve, F.col("quote_rate_3m")),
        "base_10y": F.when(curve, F.col("base_yield_10y")),
        "quote_10y": F.when(curve, F.col("quote_yield_10y")),
        "base_equity": F.when(equities, F.col("base_local_equity")),
        "quote_equity": F.when(equities, F.col("quote_local_equity")),
        "cds": F.when(~is_g10, of_leg("cds_5y")),
        "equity": F.when(~is_g10, of_leg("local_equity")),
        "offshore": F.when(is_chn, F.lit(OFFSHORE_SERIES)),
        "onshore": F.when(is_chn, F.lit(ONSHORE_SERIES)),
        **{slot: F.when(is_chn, F.lit(code)) for slot, code in FLOWS.items()},
    }
    entries = F.array(
        *[F.struct(F.lit(s).alias("slot"), c.alias(SOURCE_CODE)) for s, c in sources.items()]
    )
    return report.select(SERIES_CODE, "universe", F.inline(entries)).filter(
        F.col(SOURCE_CODE).isNotNull()
    )


def required_series(mapping: DataFrame) -> DataFrame:
    """Distinct series a whole run reads."""
    return mapping.select(F.col(SOURCE_CODE).alias(SERIES_CODE)).distinct()


def flows_cutover(catalog: DataFrame) -> date:
    """The day the flows driver changes formula: the one end date its four series share."""
    ends = (
        catalog.filter(F.col(SERIES_CODE).isin(*BUY_SELL_SERIES.values()))
        .select(parse_timestamp(F.col("valid_to")).cast("date").alias("d"))
        .filter("d IS NOT NULL")
        .distinct()
        .limit(2)
        .collect()
        if "valid_to" in catalog.columns
        else []
    )
    if len(ends) != 1:
        raise ValueError(
            f"expected one end date shared by {sorted(BUY_SELL_SERIES.values())}, "
            f"found {[str(row['d']) for row in ends]}"
        )
    return ends[0]["d"]


def flows_complete(values: DataFrame) -> bool:
    """Whether each of the six flow series has some value: without one there is no driver."""
    rows = select_codes(values, list(FLOWS.values())).filter(F.col(VALUE).isNotNull())
    return rows.select(SERIES_CODE).distinct().count() == len(FLOWS)


def driver_formulas(cutover: date | None) -> dict[str, Column]:
    """Driver columns over the slots. A missing input makes its driver NULL; nothing is ever
    substituted for it."""
    c = F.col
    is_g10 = c("universe") == G10
    is_chn = c("universe") == CHN
    curve = (c("base_3m") - c("base_10y")) - (c("quote_3m") - c("quote_10y"))
    net = c("shanghai_buy") + c("shenzhen_buy") - (c("shanghai_sell") + c("shenzhen_sell"))
    turnover = c("shanghai_turnover") + c("shenzhen_turnover")
    if cutover is None:
        flows = F.lit(None).cast("double")
    else:
        by_regime = F.when(c("day") < F.lit(cutover), net).otherwise(turnover)
        flows = F.when(is_chn, by_regime)
    return {
        "interest_rate_differential": c("base_swap") - c("quote_swap"),
        "yield_curve_or_cds": F.when(is_g10, curve).otherwise(c("cds")),
        "local_equity": F.when(
            is_g10, log_level(c("base_equity")) - log_level(c("quote_equity"))
        ).otherwise(log_level(c("equity"))),
        "global_equity": log_level(c("world_equity")),
        "commodity": log_level(c("oil")),
        "offshore_spread": F.when(is_chn, c("offshore") - c("onshore")),
        "flows": flows,
    }


def raw_driver_frame(
    values: DataFrame, mapping: DataFrame, *, cutover: date | None = None
) -> DataFrame:
    """(series_code, universe, day, rate, drivers...) on the days any input has a value.

    Each input series is read once for the whole run: values are filtered by the mapping, the
    small side, where they are read, and reduced to one per (series, day), keys no hot series
    can skew. Only then are they fanned out to the pairs that use them and lined up per
    (pair, day).
    """
    # Written out: used twice, and its real size decides how it is joined.
    small = cut_lineage(mapping, "mapping")
    needed = values.join(small.select(F.col(SOURCE_CODE).alias(SERIES_CODE)), SERIES_CODE, "left_semi")
    daily = daily_last(needed).withColumnRenamed(SERIES_CODE, SOURCE_CODE)
    slots = [F.max(F.when(F.col("slot") == slot, F.col(VALUE))).alias(slot) for slot in SLOTS]
    wide = (
        daily.join(small, SOURCE_CODE)
        .groupBy(SERIES_CODE, "universe", F.col(TIMESTAMP).cast("date").alias("day"))
        .agg(*slots)
    )
    return wide.select(
        SERIES_CODE,
        "universe",
        "day",
        RATE,
        *[formula.alias(name) for name, formula in driver_formulas(cutover).items()],
    )


def spans_cutover(raw: DataFrame, cutover: date) -> DataFrame:
    """China pairs whose history mixes both flow regimes."""
    return (
        raw.filter(F.col("universe") == CHN)
        .groupBy(SERIES_CODE)
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
        .filter((F.col("first_day") < F.lit(cutover)) & (F.lit(cutover) <= F.col("last_day")))
    )


def conform_drivers(raw: DataFrame) -> DataFrame:
    """Raw driver rows on each pair's business-day grid, bounded by its own rate."""
    return conform_to_business_days(
        raw,
        keys=[SERIES_CODE, "universe"],
        columns=[RATE, *CHINA_DRIVERS],
        primary=RATE,
        day="day",
    )


def by_universe(attribute: str, universes: Mapping[str, Universe] = UNIVERSES) -> Column:
    """A universe parameter as a column."""
    chain = None
    for name, universe in universes.items():
        value = F.lit(getattr(universe, attribute))
        here = F.col("universe") == name
        chain = F.when(here, value) if chain is None else chain.when(here, value)
    return chain


def build_features(
    conformed: DataFrame, universes: Mapping[str, Universe] = UNIVERSES
) -> DataFrame:
    """Driver rows with realised volatility and the log-or-level regime of each day."""
    lengths = {universe.volatility_days for universe in universes.values()}
    if len(lengths) != 1:
        raise ValueError("universes fitted together must share volatility_days")
    with_volatility = realized_volatility(
        conformed,
        value=RATE,
        keys=[SERIES_CODE, "universe"],
        order="day",
        length=lengths.pop(),
    )
    threshold = by_universe("logged_rate_threshold", universes)
    return with_volatility.withColumn(
        "is_logged", F.coalesce(F.col("realized_volatility") > threshold, F.lit(False))
    )


def feature_rules() -> list[Rule]:
    """Checks a pair's features must pass before estimation."""
    rules = [
        Rule(f"{RATE} out of range", "range", out_of_range(RATE, *RATE_RANGE, nullable=False)),
        Rule(
            "realized_volatility out of range",
            "range",
            out_of_range("realized_volatility", 0.0, 1.0),
        ),
    ]
    for name in CHINA_DRIVERS:
        broken = F.col(name).isNotNull() & ~is_finite(F.col(name))
        rules.append(Rule(f"{name} not finite", "finite", broken))
    return rules


def feature_summary(features: DataFrame) -> DataFrame:
    """Pairs, rows and the share of log-regime rows per universe."""
    return features.groupBy("universe").agg(
        F.count_distinct(SERIES_CODE).alias("pairs"),
        F.count("*").alias("rows"),
        F.avg(F.col("is_logged").cast("double")).alias("logged_share"),
    )


def stale_pairs(
    raw: DataFrame, as_of: Column, *, tolerance_days: int = 3, per_rate: bool = True
) -> DataFrame:
    """Pairs whose newest data is too old; by default the rate itself must be fresh."""
    rows = raw.filter(F.col(RATE).isNotNull()) if per_rate else raw
    ages = freshness(rows, as_of, tolerance_days=tolerance_days, day="day")
    known = raw.select(SERIES_CODE).distinct().join(ages, SERIES_CODE, "left")
    return known.filter(~F.coalesce("is_fresh", F.lit(False))).select(
        SERIES_CODE, "latest", "age_days"
    )


#: Days a pair's rate may be old.
TOLERANCE_DAYS = 3


def open_raw(values: DataFrame, report: DataFrame, *, cutover: date | None = None) -> DataFrame:
    """Raw driver rows of the pairs that are not blocked."""
    open_pairs = report.filter(~F.col("blocked"))
    return raw_driver_frame(values, series_mapping(open_pairs), cutover=cutover)


def moment_of(as_of: date | str | None) -> Column:
    """The day a run looks back from; today when none is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("timestamp").cast("date")


def silver_frame(
    values: DataFrame,
    report: DataFrame,
    *,
    as_of: date | str | None = None,
    cutover: date | None = None,
    per_rate: bool = True,
    tolerance_days: int = TOLERANCE_DAYS,
    raw: DataFrame | None = None,
) -> DataFrame:
    """Conformed driver rows of the pairs that are neither blocked nor stale. ``raw`` takes rows that
    are already at hand."""
    raw = open_raw(values, report, cutover=cutover) if raw is None else raw
    rate_or_any = F.col(RATE).isNotNull() if per_rate else F.lit(True)
    latest = raw.filter(rate_or_any).groupBy(SERIES_CODE).agg(F.max("day").alias("latest"))
    fresh = latest.filter(F.datediff(moment_of(as_of), F.col("latest")) <= tolerance_days)
    return conform_drivers(raw.join(fresh.select(SERIES_CODE), SERIES_CODE, "left_semi"))
