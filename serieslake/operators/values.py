"""Value-table operators: scan, last-wins, last value, existence, vendor routing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.functions.text import canonical_source
from serieslake.operators.joins import small_side
from serieslake.schema import (
    DEFAULT_SOURCE,
    SEQ,
    SERIES_CODE,
    TICKER_SOURCE,
    TICKER_SOURCES,
    TIMESTAMP,
    VALUE,
    VERSION,
    InvalidOrderByError,
    InvalidQueryError,
    MissingMetadataColumnError,
    SeriesCodesRequiredError,
    normalize_source,
)

Moment = datetime | str | None


def save_order(frame: DataFrame) -> list[str]:
    """Columns that order repeated saves of one (series, timestamp), oldest first."""
    return [column for column in (VERSION, SEQ) if column in frame.columns]


def order_key(*columns: Column | str) -> Column:
    """One orderable key. A single number stays bare: max_by over it hash-aggregates, while
    a struct key makes Spark sort each task's rows first (about four times slower)."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return parts[0] if len(parts) == 1 else F.struct(*parts)


def time_order(frame: DataFrame) -> Column:
    """Order of a series' rows in time, repeats by save order. A frame that records no save
    order must hold one row per (series, timestamp)."""
    return order_key(TIMESTAMP, *save_order(frame))


def select_codes(frame: DataFrame, codes: DataFrame | Sequence[str]) -> DataFrame:
    """Rows of the given series: a list, or a table with a code column (repeats do no harm).

    A table of codes is semi-joined: sent to every executor when counted small, so that values
    are filtered where they are read; otherwise shuffled, with hot series split.
    """
    if isinstance(codes, DataFrame):
        wanted = small_side(codes.select(SERIES_CODE))
        return frame.join(wanted, SERIES_CODE, "left_semi")
    if not codes:
        raise SeriesCodesRequiredError("at least one series code is needed")
    return frame.filter(F.col(SERIES_CODE).isin(list(codes)))


def between(frame: DataFrame, start: Moment = None, end: Moment = None) -> DataFrame:
    """Closed time range. A stored ``year`` partition column gets its own predicate so that
    whole partitions are skipped."""
    low = None if start is None else F.lit(start).cast("timestamp_ntz")
    high = None if end is None else F.lit(end).cast("timestamp_ntz")
    if low is not None:
        frame = frame.filter(F.col(TIMESTAMP) >= low)
    if high is not None:
        frame = frame.filter(F.col(TIMESTAMP) <= high)
    if "year" in frame.columns:
        if low is not None:
            frame = frame.filter(F.col("year") >= F.year(low))
        if high is not None:
            frame = frame.filter(F.col("year") <= F.year(high))
    return frame


def top_rows(
    frame: DataFrame, order_by: str | None, ascending: bool = True, limit: int | None = None
) -> DataFrame:
    """Sort and cap long rows. A cap without an order is by time. Ties follow the series code and
    save order, so the rows a cap keeps are the same on every run."""
    if order_by is None and limit is not None and TIMESTAMP in frame.columns:
        order_by = TIMESTAMP
    if order_by is not None:
        if order_by not in frame.columns:
            raise InvalidOrderByError(f"cannot sort by {order_by!r}; columns: {frame.columns}")
        ties = [c for c in (TIMESTAMP, SERIES_CODE, *save_order(frame)) if c != order_by]
        lead = F.col(order_by).asc() if ascending else F.col(order_by).desc()
        frame = frame.orderBy(lead, *[c for c in ties if c in frame.columns])
    if limit is not None:
        if limit <= 0:
            raise InvalidQueryError(f"limit must be positive, got {limit}")
        frame = frame.limit(limit)
    return frame


def scan(
    frame: DataFrame,
    *,
    codes: DataFrame | Sequence[str] | None = None,
    source: str | None = None,
    start: Moment = None,
    end: Moment = None,
    order_by: str | None = None,
    ascending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Value rows under AND-ed predicates, then sort and cap; every predicate reaches the scan."""
    if source is not None:
        frame = frame.filter(F.col(TICKER_SOURCE) == normalize_source(source))
    frame = between(frame, start, end)
    if codes is not None:
        frame = select_codes(frame, codes)
    return top_rows(frame, order_by, ascending, limit)


def last_wins(frame: DataFrame, *keep: str) -> DataFrame:
    """One row per (series, timestamp): the latest saved non-NULL value.

    An aggregate on the full key, so a hot series spreads over all tasks and repeats collapse
    before the shuffle.
    """
    order = order_key(*(save_order(frame) or [VALUE]))
    return (
        frame.filter(F.col(VALUE).isNotNull())
        .groupBy(SERIES_CODE, TIMESTAMP)
        .agg(
            F.max_by(VALUE, order).alias(VALUE),
            *[F.max_by(column, order).alias(column) for column in keep],
        )
    )


def last_value(frame: DataFrame, *keep: str) -> DataFrame:
    """Latest non-NULL value per series, ties settled by save order.

    max_by combines inside each task first: one row per series and task is shuffled, however
    many rows a series has.
    """
    order = order_key(TIMESTAMP, *(save_order(frame) or [VALUE]))
    latest = F.max_by(F.struct(TIMESTAMP, VALUE, *keep), order).alias("latest")
    return (
        frame.filter(F.col(VALUE).isNotNull())
        .groupBy(SERIES_CODE)
        .agg(latest)
        .select(SERIES_CODE, "latest.*")
    )


def value_exists(frame: DataFrame) -> DataFrame:
    """Series that have at least one row; absent series are simply not listed."""
    return frame.groupBy(SERIES_CODE).agg((F.count("*") > 0).alias("has_values"))


def count_points(frame: DataFrame) -> DataFrame:
    """Number of non-NULL data points."""
    return frame.agg(F.count(VALUE).alias("data_points"))


def route_by_default_source(
    values: DataFrame, catalog: DataFrame, *, validate: bool = True
) -> DataFrame:
    """Read each series from the vendor its catalog row names.

    With ``validate`` a series without a usable vendor is an error (a small job over the
    catalog); otherwise such series match nothing.
    """
    if DEFAULT_SOURCE not in catalog.columns:
        raise MissingMetadataColumnError(f"catalog has no {DEFAULT_SOURCE!r} column")
    routed = catalog.select(
        SERIES_CODE, canonical_source(F.col(DEFAULT_SOURCE)).alias(TICKER_SOURCE)
    )
    if validate:
        bad = routed.filter(~F.coalesce(F.col(TICKER_SOURCE).isin(*TICKER_SOURCES), F.lit(False)))
        codes = [row[SERIES_CODE] for row in bad.limit(5).collect()]
        if codes:
            raise InvalidQueryError(f"missing or invalid {DEFAULT_SOURCE} for series: {codes}")
    return values.join(small_side(routed.distinct()), [SERIES_CODE, TICKER_SOURCE], "left_semi")
