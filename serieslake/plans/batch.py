"""The scheduled loads: vendor values into the lake, and the catalog from files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serieslake.api import DataAPI
from serieslake.operators.catalog import ticker_selection
from serieslake.operators.quality import failure_counts, metadata_failures, value_failures
from serieslake.operators.values import Moment
from serieslake.schema import SERIES_CODE, VALUE, normalize_source, vendor_columns

PREVIEW_ROWS = 10


@dataclass(frozen=True)
class LoadReport:
    """What a load did. ``failures`` and ``preview`` are small frames for the log."""

    rows: int
    series: int
    points: int
    passed: bool
    failures: DataFrame
    preview: DataFrame


def load_vendor_values(
    api: DataAPI,
    vendor: str,
    *,
    codes: Sequence[str] | None = None,
    start: Moment = None,
    end: Moment = None,
) -> LoadReport:
    """Fetch every series that has a ticker with the vendor, save it, and check what came."""
    ticker, _ = vendor_columns(normalize_source(vendor))
    selected = ticker_selection(api.catalog(), ticker, codes)
    saved = api.ingest(vendor, selected.select(SERIES_CODE), start=start, end=end)
    failures = value_failures(saved)
    counts = saved.agg(
        F.count("*").alias("rows"),
        F.count_distinct(SERIES_CODE).alias("series"),
        F.count(VALUE).alias("points"),
    ).first()
    return LoadReport(
        counts["rows"], counts["series"], counts["points"], failures.isEmpty(), failures,
        saved.orderBy(SERIES_CODE, "timestamp").limit(PREVIEW_ROWS),
    )


def load_catalog(api: DataAPI, path: str, *, sheet: str | int = 0) -> LoadReport:
    """Replace the catalog rows a file brings, then check the whole catalog."""
    api.import_metadata(path=path, sheet=sheet, fresh=True)
    catalog = api.catalog()
    failures = failure_counts(metadata_failures(catalog))
    counts = catalog.agg(
        F.count("*").alias("rows"), F.count_distinct(SERIES_CODE).alias("series")
    ).first()
    return LoadReport(
        counts["rows"], counts["series"], 0, failures.isEmpty(), failures,
        catalog.orderBy(SERIES_CODE).limit(PREVIEW_ROWS),
    )
