"""Date and time expressions. All timestamps are UTC wall-clock without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000
#: Text layouts tried in order by :func:`parse_timestamp`.
TEXT_LAYOUTS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "yyyy-MM-dd",
    "yyyyMMdd",
    "yyyy/MM/dd",
    "dd MMM yyyy",
    "d MMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
)


def floor_day(timestamp: Column) -> Column:
    """Midnight of the timestamp's day, without a zone."""
    return F.date_trunc("day", timestamp).cast("timestamp_ntz")


def to_utc(timestamp: Column, zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` moved to UTC wall-clock time."""
    return F.to_utc_timestamp(timestamp.cast("timestamp"), zone).cast("timestamp_ntz")


def truncate_precision(timestamp: Column, digits: int = 6) -> Column:
    """Timestamp with only ``digits`` fractional-second digits kept."""
    if digits >= 6:
        return timestamp
    step = 10 ** (6 - digits)
    micros = F.unix_micros(timestamp.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step))).cast("timestamp_ntz")


def parse_timestamp(text: Column) -> Column:
    """Timestamp from ISO text, ``YYYYMMDD`` or common written dates; NULL when none fits."""
    cleaned = F.trim(text.cast("string"))
    attempts = [
        F.try_to_timestamp(cleaned, F.lit(layout)).cast("timestamp_ntz") for layout in TEXT_LAYOUTS
    ]
    return F.coalesce(*attempts)


def is_business_day(day: Column) -> Column:
    """Monday to Friday."""
    return F.weekday(day) < 5


def months_before(day: Column, months: int) -> Column:
    """The day ``months`` calendar months earlier, clamped to the end of a shorter month."""
    return F.add_months(day, -months)


def age_days(as_of: Column, timestamp: Column) -> Column:
    """Whole days between a timestamp and ``as_of``."""
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(timestamp.cast("timestamp"))
    # In whole numbers: a fraction of a second short of a day is not yet that day.
    whole = micros - F.pmod(micros, F.lit(DAY_MICROS))
    return (whole / F.lit(DAY_MICROS)).cast("int")


def week_ending_sunday(timestamp: Column) -> Column:
    """Sunday that closes the timestamp's week (the label of a weekly bar)."""
    return F.date_add(timestamp.cast("date"), 6 - F.weekday(timestamp)).cast("timestamp_ntz")


def month_end(timestamp: Column) -> Column:
    return F.last_day(timestamp).cast("timestamp_ntz")


def quarter_end(timestamp: Column) -> Column:
    start = F.date_trunc("quarter", timestamp)
    return F.last_day(F.add_months(start, 2)).cast("timestamp_ntz")


def year_end(timestamp: Column) -> Column:
    return F.last_day(F.add_months(F.date_trunc("year", timestamp), 11)).cast("timestamp_ntz")


#: Period label per resampling frequency.
PERIOD_LABELS = {
    "D": floor_day,
    "W": week_ending_sunday,
    "M": month_end,
    "ME": month_end,
    "Q": quarter_end,
    "QE": quarter_end,
    "Y": year_end,
    "YE": year_end,
}


def period_label(timestamp: Column, freq: str) -> Column:
    """Label of the period a timestamp falls in."""
    try:
        return PERIOD_LABELS[freq.upper()](timestamp)
    except KeyError:
        raise ValueError(f"unknown frequency {freq!r}; use one of {sorted(PERIOD_LABELS)}") from None
