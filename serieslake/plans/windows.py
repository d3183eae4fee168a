"""Sums of products over trailing windows, as differences of running totals.

Every fit needs the sums, squares and products of its window's complete rows. Rows of a pair are
set apart by which cells they miss, and each pattern gets running totals in one window pass. A fit
puts two marks on the line, at the end of its window and at its start; the totals there differ by
the window's sums. Patterns add up, so the same totals serve the first fit (rows that miss nothing)
and a refit on fewer drivers (rows that miss at most the dropped ones) without reading a row again.
Cells are centred by the pair's first values, which keeps the differences from cancelling and lets no
later row touch an earlier fit.

A pair has one row per business day, so a window partition is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from serieslake.functions.numeric import is_finite
from serieslake.plans.drivers import RATE
from serieslake.schema import SERIES_CODE

PAIR = [SERIES_CODE, "universe"]
KEYS = [*PAIR, "as_of"]
#: Months are 32 units long, so that a window of N months is a plain integer range.
MONTH_UNITS = 32
LEVEL, LOG = "_level", "_log"


def month_key(day: Column) -> Column:
    """A day as an integer in which N months are exactly ``MONTH_UNITS * N``.

    Day numbers never reach 32, so "after the day N months earlier, clamped to the month's
    end" is the same as "key greater than key - 32 N".
    """
    return (F.year(day) * 12 + F.month(day)) * MONTH_UNITS + F.dayofmonth(day)


def value_names(drivers: Sequence[str]) -> list[str]:
    """Cells of a row in the order of the sums: both responses, then the drivers."""
    return [LEVEL, LOG, *drivers]


def sum_places(count: int) -> dict[tuple[int, int], int]:
    """Where the sum of cells i times j lies; cell -1 is the constant."""
    cells = range(-1, count)
    return {pair: at for at, pair in enumerate((i, j) for i in cells for j in cells if i <= j)}


def cells(features: DataFrame, drivers: Sequence[str]) -> DataFrame:
    """Rows with both responses, finite cells only, and ``mask``: a bit for every missing cell."""
    rate = F.when(is_finite(F.col(RATE)), F.col(RATE).cast("double"))
    shaped = features.select(
        *PAIR,
        F.col("day").cast("date").alias("day"),
        "is_logged",
        F.col(RATE).cast("double").alias(RATE),
        rate.alias(LEVEL),
        F.when(rate > 0, F.ln(rate)).alias(LOG),
        *[F.when(is_finite(F.col(name)), F.col(name).cast("double")).alias(name) for name in drivers],
    )
    mask = F.lit(0)
    for place, name in enumerate(value_names(drivers)):
        mask = mask + F.when(F.col(name).isNull(), F.lit(1 << place)).otherwise(F.lit(0))
    return shaped.withColumn("mask", mask).withColumn("key", month_key(F.col("day")))


def listed_dates(dates: Sequence[date] | Mapping[str, Sequence[date]]) -> Column:
    """Dates as an array: the same for all pairs, or those of the pair's universe."""

    def listed(days: Sequence[date]) -> Column:
        return F.array(*[F.lit(d).cast("date") for d in days]).cast("array<date>")

    if not isinstance(dates, Mapping):
        return listed(dates)
    chosen = listed([])
    for name, days in dates.items():
        chosen = F.when(F.col("universe") == name, listed(days)).otherwise(chosen)
    return chosen


def fit_days(
    rows: DataFrame, dates: Sequence[date] | Mapping[str, Sequence[date]] | None, *, every_day: bool
) -> DataFrame:
    """The fits that are wanted: every day of each pair, the given days, or each pair's last."""
    if every_day:
        return rows.select(*PAIR, F.col("day").alias("as_of")).distinct()
    if dates is None:
        return rows.groupBy(*PAIR).agg(F.max("day").alias("as_of"))
    return rows.select(*PAIR).distinct().select("*", F.explode(listed_dates(dates)).alias("as_of"))


def window_sums(
    rows: DataFrame,
    drivers: Sequence[str],
    months: Column,
    *,
    fit_dates: Sequence[date] | Mapping[str, Sequence[date]] | None = None,
    every_day: bool = False,
) -> DataFrame:
    """One row per fit whose window has a row of :func:`cells`: the keys, ``centre`` (the pair's first value of
    each cell), ``classes`` and ``newest``.

    ``classes`` lists, by missing pattern, the mask, the sums of products (see :func:`sum_places`) and
    the last row; ``newest`` is the window's last row of any pattern. ``months`` may differ by universe.
    """
    names = value_names(drivers)
    centre = rows.groupBy(*PAIR).agg(
        F.array(
            *[F.coalesce(F.min_by(name, F.when(F.col(name).isNotNull(), F.col("day"))), F.lit(0.0)) for name in names]
        ).alias("centre")
    )
    moved = rows.join(centre, PAIR).select(
        *PAIR, "mask", "key", "day", "is_logged", RATE, *[(F.col(n) - F.col("centre")[k]).alias(n) for k, n in enumerate(names)]
    )
    marks = (
        fit_days(rows, fit_dates, every_day=every_day)
        .join(rows.select(*PAIR, "mask").distinct(), PAIR)
        .withColumn("end", month_key(F.col("as_of")))
    )
    ends = F.struct(F.lit(1).alias("sign"), F.col("end").alias("key"))
    starts = F.struct(F.lit(-1).alias("sign"), (F.col("end") - MONTH_UNITS * months).alias("key"))
    marks = marks.select(*PAIR, "mask", "as_of", F.inline(F.array(ends, starts)))
    line = moved.unionByName(marks, allowMissingColumns=True)
    upto = W.partitionBy(*PAIR, "mask").orderBy("key").rangeBetween(W.unboundedPreceding, W.currentRow)
    one = F.when(F.col("day").isNotNull(), F.lit(1.0))
    factor = [one, *[F.col(name) for name in names]]
    places = sum_places(len(names))
    totals = [
        F.coalesce(F.sum(factor[i + 1] * factor[j + 1]).over(upto), F.lit(0.0)).alias(f"s{at}")
        for (i, j), at in places.items()
    ]
    row = F.when(F.col("day").isNotNull(), F.struct("day", "key", "is_logged", RATE, F.array(*names).alias("cells")))
    marked = line.select(*PAIR, "as_of", "mask", "sign", *totals, F.last(row, ignorenulls=True).over(upto).alias("last"))
    sign = F.col("sign")
    by_pattern = (
        marked.filter("sign IS NOT NULL")
        .groupBy(*KEYS, "mask")
        .agg(
            *[F.sum(sign * F.col(f"s{at}")).alias(f"s{at}") for at in places.values()],
            F.max(F.when(sign == 1, F.col("last"))).alias("last"),
        )
        .filter("s0 > 0.5")
    )
    return (
        by_pattern.groupBy(*KEYS)
        .agg(
            F.collect_list(
                F.struct("mask", F.array(*[F.col(f"s{at}") for at in places.values()]).alias("sums"), "last")
            ).alias("classes"),
            F.max("last").alias("newest"),
        )
        .join(centre, PAIR)
    )
