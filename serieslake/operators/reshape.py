"""Long form (storage) to wide form (display) and back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serieslake.functions.dates import floor_day
from serieslake.functions.numeric import clean_double
from serieslake.operators.joins import small_side
from serieslake.operators.values import last_wins, order_key, save_order
from serieslake.schema import (
    SERIES_CODE,
    TICKER_SOURCE,
    TIMESTAMP,
    VALUE,
    PivotTooWideError,
)

#: Widest result a pivot may produce; beyond it the long form is the right shape.
MAX_WIDTH = 10_000
#: Up to this many columns last-wins and pivot run as one aggregate with one shuffle.
ONE_PASS_WIDTH = 64


def column_codes(frame: DataFrame, column: str = SERIES_CODE, width: int = MAX_WIDTH) -> list[str]:
    """Sorted codes that become columns; at most ``width`` names ever reach the driver."""
    rows = frame.select(column).filter(F.col(column).isNotNull()).distinct().limit(width + 1)
    codes = sorted(row[0] for row in rows.collect())
    if len(codes) > width:
        raise PivotTooWideError(f"more than {width} columns; read the long form instead")
    return codes


def pivot_values(
    frame: DataFrame, codes: Sequence[str], *, column: str = SERIES_CODE, sort: bool = True
) -> DataFrame:
    """One row per timestamp, one column per code; the latest saved non-NULL value wins.

    NULL values are dropped first, so a timestamp without any value gives no row. The code
    list is always explicit: no extra job to discover it.
    """
    if len(codes) > MAX_WIDTH:
        raise PivotTooWideError(f"{len(codes)} columns asked for, at most {MAX_WIDTH} allowed")
    if not codes:
        return frame.select(TIMESTAMP).limit(0)
    present = frame.filter(F.col(VALUE).isNotNull() & F.col(column).isin(list(codes)))
    if len(codes) <= ONE_PASS_WIDTH:
        order = order_key(*(save_order(frame) or [VALUE]))
        cells = [
            F.max_by(VALUE, F.when(F.col(column) == code, order)).alias(code) for code in codes
        ]
        wide = present.groupBy(TIMESTAMP).agg(*cells)
    else:
        keyed = present if column == SERIES_CODE else present.withColumn(SERIES_CODE, F.col(column))
        wide = (
            last_wins(keyed).groupBy(TIMESTAMP).pivot(SERIES_CODE, list(codes)).agg(F.first(VALUE))
        )
    return wide.orderBy(TIMESTAMP) if sort else wide


def row_totals(frame: DataFrame) -> DataFrame:
    """The rows of :func:`pivot_values` added up: per timestamp how many series are ``known`` and their ``total``.

    Never wide, so there is no bound on the number of series: two aggregates that combine inside tasks.
    """
    return (
        last_wins(frame)
        .groupBy(TIMESTAMP)
        .agg(F.count(VALUE).alias("known"), F.sum(VALUE).alias("total"))
    )


def melt_values(
    wide: DataFrame,
    *,
    source: str | None = None,
    timestamp: str = TIMESTAMP,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per (series, day); NULLs go, time of day and zone go.

    Of a series' values within a day the one with the latest time stays, of equal times the highest:
    the layout of the frame decides nothing. Text that is no number becomes NULL; ``watch`` sees the
    long rows (series_code, timestamp, value as text) before that.
    """
    codes = [column for column in wide.columns if column not in (timestamp, TICKER_SOURCE)]
    texts = any(isinstance(wide.schema[c].dataType, T.StringType) for c in codes)
    kind = "string" if texts else "double"
    cells = wide.select(timestamp, *[F.col(f"`{c}`").cast(kind).alias(c) for c in codes])
    rows = cells.unpivot(timestamp, codes, SERIES_CODE, VALUE)
    if watch is not None:
        rows = watch(rows)
    known = rows.withColumn(VALUE, clean_double(F.col(VALUE))).filter(F.col(VALUE).isNotNull())
    long = (
        known.groupBy(SERIES_CODE, floor_day(F.col(timestamp)).alias("_day"))
        .agg(F.max_by(VALUE, F.struct(F.col(timestamp), F.col(VALUE))).alias(VALUE))
        .select(SERIES_CODE, F.col("_day").alias(TIMESTAMP), VALUE)
    )
    return long.withColumn(TICKER_SOURCE, F.lit(source)) if source else long


def drop_empty_rows(wide: DataFrame, *, timestamp: str = TIMESTAMP) -> DataFrame:
    """Wide rows that hold at least one value."""
    return wide.dropna("all", subset=[c for c in wide.columns if c != timestamp])


def relabel(
    frame: DataFrame, catalog: DataFrame, label: str, *, code: str = SERIES_CODE
) -> DataFrame:
    """Long rows with a catalog attribute in place of the series code column's role."""
    labels = catalog.select(code, F.col(label).alias("_label")).filter("_label IS NOT NULL")
    return frame.join(small_side(labels.distinct()), code).withColumnRenamed("_label", label)


def matrix_by_label(
    frame: DataFrame, catalog: DataFrame, label: str = "currency", *, sort: bool = True
) -> DataFrame:
    """Wide values whose columns are named by a catalog attribute (one series per label).

    Two series under one label are an error: no rule says which owns the column.
    """
    clashes = (
        catalog.filter(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count_distinct(SERIES_CODE).alias("n"))
        .filter("n > 1")
        .limit(5)
        .collect()
    )
    if clashes:
        raise ValueError(f"more than one series for {label}: {[row[label] for row in clashes]}")
    labels = column_codes(catalog, label)
    return pivot_values(relabel(frame, catalog, label), labels, column=label, sort=sort)
