"""Column names, table schemas, vendor aliases and the errors callers can catch."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES_CODE = "series_code"
SERIES_NAME = "series_name"
TIMESTAMP = "timestamp"
VALUE = "value"
TICKER_SOURCE = "ticker_source"
PARENT_SERIES_CODE = "parent_series_code"
CALC_TYPE = "calc_type"
DEFAULT_SOURCE = "default_source"

#: Bookkeeping columns every stored row carries: the commit that wrote it and
#: its position inside that commit. Together they order re-saves of one key.
VERSION = "_version"
SEQ = "_seq"

#: Tables of the lake.
METADATA_TABLE = "metadata"
METADATA_DERIVED_TABLE = "metadata_derived"
VALUES_TABLE = "values"

VALUES_SCHEMA = T.StructType(
    [
        T.StructField(SERIES_CODE, T.StringType()),
        T.StructField(TIMESTAMP, T.TimestampNTZType()),
        T.StructField(VALUE, T.DoubleType()),
        T.StructField(TICKER_SOURCE, T.StringType()),
    ]
)

# The vendor names and the abbreviations accepted for them.
BLOOMBERG = "bloomberg"
HAWK = "hawk"
MDS = "mds"
UNKNOWN_SOURCE = "unknown"
TICKER_SOURCES = (BLOOMBERG, HAWK, MDS)
SOURCE_ALIASES = {
    "BBG": BLOOMBERG,
    "BLOOMBERG": BLOOMBERG,
    "HAWK": HAWK,
    "HAWKEYE": HAWK,
    "MDS": MDS,
    "ONETICK": MDS,
}


def vendor_columns(source: str) -> tuple[str, str]:
    """Catalog columns holding a vendor's ticker and field."""
    if source not in TICKER_SOURCES:
        raise UnsupportedTickerSourceError(
            f"No ticker columns for source {source!r}; expected one of {sorted(TICKER_SOURCES)}"
        )
    prefix = "bbg" if source == BLOOMBERG else source
    return f"{prefix}_ticker", f"{prefix}_field"


def normalize_source(source: str) -> str:
    """Canonical vendor name for an alias; anything unknown is lower-cased."""
    cleaned = source.strip()
    return SOURCE_ALIASES.get(cleaned.upper(), cleaned.lower())


class LakeError(Exception):
    """Base class of every error raised on purpose by this package."""


class FrameValidationError(LakeError):
    """A frame does not satisfy the schema of the table it is meant for."""


class SeriesCodesRequiredError(LakeError):
    """A value read was asked for without any series code."""


class UnsupportedFileTypeError(LakeError):
    """The file extension has no reader."""


class InvalidOrderByError(LakeError):
    """The order_by column is not part of the result."""


class MissingMetadataColumnError(LakeError):
    """The catalog lacks a column needed for a vendor read."""


class UnsupportedTickerSourceError(LakeError):
    """The source has no ticker and field columns."""


class UnsupportedVendorError(LakeError):
    """No reader is registered under the vendor name."""


class UnknownCalcTypeError(LakeError):
    """A derived series names a calculator that does not exist."""


class InvalidParentSeriesCountError(LakeError):
    """A derived series lists the wrong number of parents."""


class SnapshotConflictError(LakeError):
    """Both a version and a point in time were given."""


class SnapshotNotFoundError(LakeError):
    """Nothing had been committed yet at the requested snapshot."""


class TickerSourceRequiredError(LakeError):
    """A live read needs to know its vendor."""


class DirectFetchUnavailableError(LakeError):
    """A live read was asked for but no vendor registry is configured."""


class InvalidQueryError(LakeError):
    """Query parameters contradict each other."""


class InvalidFilterFieldError(LakeError):
    """A filter names a column that does not exist."""


class InvalidFilterValueError(LakeError):
    """Strict mode: a filter value does not occur in the column."""


class InvalidImportSourceError(LakeError):
    """Exactly one of frame and path must be given."""


class PivotTooWideError(LakeError):
    """The wide result would have more columns than allowed; read long form instead."""


class InsufficientDataError(LakeError):
    """Not enough complete observations."""
