"""Calendars, business-day conforming, resampling and month windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from serieslake.functions.dates import (
    floor_day,
    is_business_day,
    months_before,
    period_label,
)
from serieslake.operators.rolling import forward_fill
from serieslake.operators.values import time_order
from serieslake.schema import SERIES_CODE, TIMESTAMP, VALUE

#: Longest gap, in business days, that conforming fills.
MAX_FILL_DAYS = 3


def _one_day() -> Column:
    return F.expr("INTERVAL 1 DAY")


def day_list(spark: SparkSession, start: date | datetime | str, end: date | datetime | str):
    """Every calendar day of a closed range, at midnight."""
    bounds = spark.range(1).select(
        F.lit(str(start)).cast("date").alias("s"), F.lit(str(end)).cast("date").alias("e")
    )
    days = F.when(F.col("s") <= F.col("e"), F.sequence("s", "e", _one_day()))
    return bounds.select(F.explode(days).alias("d")).select(
        F.col("d").cast("timestamp_ntz").alias("day")
    )


def business_days(frame: DataFrame, keys: Sequence[str] = (SERIES_CODE,)) -> DataFrame:
    """Monday-to-Friday days between each key's first and last timestamp."""
    bounds = frame.groupBy(*keys).agg(
        F.min(TIMESTAMP).cast("date").alias("s"), F.max(TIMESTAMP).cast("date").alias("e")
    )
    days = bounds.select(*keys, F.explode(F.sequence("s", "e", _one_day())).alias("d"))
    return days.filter(is_business_day(F.col("d"))).select(
        *keys, F.col("d").cast("timestamp_ntz").alias("day")
    )


def year_months(frame: DataFrame, keys: Sequence[str] = (SERIES_CODE,)) -> DataFrame:
    """Every (year, month) between each key's first and last timestamp."""
    bounds = frame.groupBy(*keys).agg(
        F.trunc(F.min(TIMESTAMP), "MM").alias("s"), F.max(TIMESTAMP).cast("date").alias("e")
    )
    months = F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 MONTH")))
    return bounds.select(*keys, months.alias("m")).select(
        *keys, F.year("m").alias("year"), F.month("m").alias("month")
    )


def dates_by_month(days: DataFrame, day: str = "day", keys: Sequence[str] = ()) -> DataFrame:
    """Days bucketed by (year, month); a bucket holds at most 31 distinct days per key."""
    distinct = days.select(*keys, F.col(day).cast("date").alias("d")).distinct()
    return distinct.groupBy(*keys, F.year("d").alias("year"), F.month("d").alias("month")).agg(
        F.sort_array(F.collect_list("d")).alias("days")
    )


def daily_last(frame: DataFrame) -> DataFrame:
    """One value per (series, day): the last non-NULL one by timestamp, then save order."""
    day = floor_day(F.col(TIMESTAMP))
    return (
        frame.filter(F.col(VALUE).isNotNull())
        .groupBy(SERIES_CODE, day.alias("_day"))
        .agg(F.max_by(VALUE, time_order(frame)).alias(VALUE))
        .select(SERIES_CODE, F.col("_day").alias(TIMESTAMP), VALUE)
    )


def conform_to_business_days(
    wide: DataFrame,
    *,
    keys: Sequence[str],
    columns: Sequence[str],
    primary: str | None = None,
    max_fill_days: int = MAX_FILL_DAYS,
    day: str = TIMESTAMP,
) -> DataFrame:
    """Business-day grid per key with short gaps filled, longer ones left NULL.

    Input: at most one row per (key, day), so every window below is bounded by the calendar.
    The grid runs between the first and last day on which ``primary`` is known (any row when
    None). Weekend rows are discarded, not moved. Missing days come from exploding the gap to
    the key's next row, so no calendar table is joined and there is a single shuffle.
    """
    by_key = W.partitionBy(*keys)
    ordered = by_key.orderBy(day)
    known = F.when(F.col(primary).isNotNull(), F.col(day)) if primary else F.col(day)
    bounded = wide.select(
        *keys,
        F.col(day).cast("date").alias("_from"),
        *columns,
        F.min(known).over(by_key).cast("date").alias("_first"),
        F.max(known).over(by_key).cast("date").alias("_last"),
        F.lead(F.col(day).cast("date")).over(ordered).alias("_next"),
    )
    until = F.greatest(F.col("_from"), F.date_sub(F.coalesce("_next", F.date_add("_from", 1)), 1))
    grid = (
        bounded.withColumn("_day", F.explode(F.sequence("_from", until, _one_day())))
        .filter(F.col("_day").between(F.col("_first"), F.col("_last")))
        .filter(is_business_day(F.col("_day")))
    )
    observed = grid.select(
        *keys,
        F.col("_day").alias(day),
        *[F.when(F.col("_day") == F.col("_from"), F.col(c)).alias(c) for c in columns],
    )
    window = W.partitionBy(*keys).orderBy(day)
    return observed.select(
        *keys,
        F.col(day).cast("timestamp_ntz").alias(day),
        *[forward_fill(F.col(c), window, max_fill_days).alias(c) for c in columns],
    )


def conform_series(frame: DataFrame, *, max_fill_days: int = MAX_FILL_DAYS) -> DataFrame:
    """Business-day grid for long rows, each series on its own calendar."""
    return conform_to_business_days(
        daily_last(frame),
        keys=[SERIES_CODE],
        columns=[VALUE],
        primary=VALUE,
        max_fill_days=max_fill_days,
    )


def resample_last(frame: DataFrame, freq: str = "W") -> DataFrame:
    """Last value of each period, labelled by the period."""
    return (
        frame.filter(F.col(VALUE).isNotNull())
        .groupBy(SERIES_CODE, period_label(F.col(TIMESTAMP), freq).alias("period"))
        .agg(F.max_by(VALUE, time_order(frame)).alias(VALUE))
    )


def in_month_window(day: Column, as_of: Column, months: int) -> Column:
    """True for ``as_of - months < day <= as_of``."""
    day = day.cast("date")
    as_of = as_of.cast("date")
    return (day > months_before(as_of, months)) & (day <= as_of)


def month_window(
    frame: DataFrame, as_of: date | datetime | str, months: int, *, day: str = TIMESTAMP
) -> DataFrame:
    """Rows of the trailing calendar-month window, complete rows only."""
    end = F.lit(str(as_of)).cast("timestamp").cast("date")
    return frame.filter(in_month_window(F.col(day), end, months)).dropna("any")


def last_days(
    frame: DataFrame,
    count: int,
    *,
    as_of: date | datetime | str | None = None,
    day: str = TIMESTAMP,
) -> DataFrame:
    """The last ``count`` distinct days on or before ``as_of`` (top-k over distinct days)."""
    days = frame.select(F.col(day).cast("date").alias("day")).distinct()
    if as_of is not None:
        days = days.filter(F.col("day") <= F.lit(str(as_of)).cast("timestamp").cast("date"))
    return days.orderBy(F.col("day").desc()).limit(count)

