"""Live vendor reads: a registry of readers, ticker fan-out, and ingestion.

A reader takes the session, a frame of requests (``ticker``, ``field``) and a time range, and
returns quotes (``ticker``, ``field``, ``timestamp``, ``value``) as a DataFrame. Each distinct
ticker is requested once; its quotes are then joined to every series that uses it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serieslake.functions.dates import floor_day
from serieslake.functions.numeric import clean_double
from serieslake.functions.text import blank_to_null
from serieslake.operators.joins import small_side
from serieslake.operators.values import Moment, between
from serieslake.schema import (
    BLOOMBERG,
    SERIES_CODE,
    TICKER_SOURCE,
    TIMESTAMP,
    VALUE,
    MissingMetadataColumnError,
    UnsupportedVendorError,
    normalize_source,
    vendor_columns,
)

TICKER = "ticker"
FIELD = "field"
Reader = Callable[[SparkSession, DataFrame, Moment, Moment], DataFrame]


class VendorRegistry:
    """Vendor name to reader."""

    def __init__(self, readers: dict[str, Reader] | None = None) -> None:
        self._readers: dict[str, Reader] = {}
        for name, reader in (readers or {}).items():
            self.register(name, reader)

    def register(self, name: str, reader: Reader) -> None:
        self._readers[normalize_source(name)] = reader

    def fetch(
        self, spark: SparkSession, vendor: str, requests: DataFrame, start: Moment, end: Moment
    ) -> DataFrame:
        name = normalize_source(vendor)
        if name not in self._readers:
            raise UnsupportedVendorError(
                f"no reader for vendor {vendor!r}; registered: {sorted(self._readers)}"
            )
        return self._readers[name](spark, requests, start, end)


def table_reader(quotes: DataFrame) -> Reader:
    """A reader over a table of quotes, for vendors that deliver files or tables."""

    def read(_: SparkSession, requests: DataFrame, start: Moment, end: Moment) -> DataFrame:
        wanted = between(quotes, start, end)
        keys = [TICKER, FIELD] if FIELD in quotes.columns else [TICKER]
        return wanted.join(small_side(requests.select(*keys).distinct()), keys, "left_semi")

    return read


def ticker_map(catalog: DataFrame, source: str) -> DataFrame:
    """(series_code, ticker, field) of the series a vendor can serve."""
    ticker, field = vendor_columns(source)
    missing = [c for c in (SERIES_CODE, ticker, field) if c not in catalog.columns]
    if missing:
        raise MissingMetadataColumnError(f"catalog lacks column(s) {missing} for {source!r}")
    mapping = catalog.select(
        blank_to_null(F.col(SERIES_CODE)).alias(SERIES_CODE),
        blank_to_null(F.col(ticker)).alias(TICKER),
        blank_to_null(F.col(field)).alias(FIELD),
    ).dropna(subset=[SERIES_CODE, TICKER])
    if source == BLOOMBERG:
        # This vendor serves one field per request, so a ticker without a field gets nothing.
        return mapping.dropna(subset=[FIELD]).distinct()
    return mapping.distinct()


def fan_out(quotes: DataFrame, mapping: DataFrame, *, by_field: bool = False) -> DataFrame:
    """Quotes joined to every series that shares their ticker."""
    keys = [TICKER, FIELD] if by_field else [TICKER]
    users = small_side(mapping.select(SERIES_CODE, *keys).distinct())
    return quotes.join(users, keys).select(
        SERIES_CODE, TIMESTAMP, VALUE
    )


def live_values(
    registry: VendorRegistry,
    catalog: DataFrame,
    codes: DataFrame,
    source: str,
    *,
    start: Moment = None,
    end: Moment = None,
) -> DataFrame:
    """Daily values of the given series straight from a vendor: each day's last known quote."""
    spark = catalog.sparkSession
    source = normalize_source(source)
    mapping = ticker_map(catalog.join(codes, SERIES_CODE, "left_semi"), source)
    requests = mapping.select(TICKER, FIELD).distinct()
    quotes = registry.fetch(spark, source, requests, start, end)
    by_field = source == BLOOMBERG and FIELD in quotes.columns
    keys = [name for name in (TICKER, FIELD) if name in quotes.columns]
    # Reduced by the time of the quote, before the day hides it.
    daily = (
        quotes.withColumn(VALUE, clean_double(F.col(VALUE)))
        .filter(F.col(VALUE).isNotNull())
        .groupBy(*keys, floor_day(F.col(TIMESTAMP)).alias("_day"))
        .agg(F.max_by(VALUE, F.struct(TIMESTAMP, VALUE)).alias(VALUE))
        .withColumnRenamed("_day", TIMESTAMP)
    )
    return fan_out(daily, mapping, by_field=by_field)


def tag_source(frame: DataFrame, source: str) -> DataFrame:
    return frame.withColumn(TICKER_SOURCE, F.lit(normalize_source(source)))
