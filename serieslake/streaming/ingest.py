"""Vendor drop files to the values table: the scheduled ingest as a streaming query.

Every micro-batch goes through the same checks and the same append as a batch load. Re-sent
or late corrections are ordinary appends: readers take the latest save, and snapshot reads
still see what was known before. Rows that are held back go to a table of their own with the
reason, so that nothing of a drop file vanishes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from serieslake.api import DataAPI
from serieslake.functions.dates import parse_timestamp
from serieslake.functions.numeric import is_finite
from serieslake.operators.quality import value_failures
from serieslake.schema import SERIES_CODE, TICKER_SOURCE, TIMESTAMP, VALUE, normalize_source
from serieslake.session import shared_dir
from serieslake.sources.files import coerce_values, strip_text

FILE_SCHEMA = f"{SERIES_CODE} string, {TIMESTAMP} string, {VALUE} string"


REJECTS_TABLE = "rejected_values"
BY_SERIES, BY_ROW = "series", "row"


def _parsed(rows: DataFrame, source: str) -> DataFrame:
    texts = strip_text(rows)
    return coerce_values(texts.withColumn("value_text", F.col(VALUE))).select(
        SERIES_CODE,
        parse_timestamp(F.col(TIMESTAMP)).alias(TIMESTAMP),
        VALUE,
        F.lit(normalize_source(source)).alias(TICKER_SOURCE),
        F.col(TIMESTAMP).alias("timestamp_text"),
        "value_text",
    )


def prepare_batch(rows: DataFrame, source: str) -> DataFrame:
    """Text rows of drop files as value rows; unusable keys go, sentinel values become NULL."""
    return (
        _parsed(rows, source)
        .drop("timestamp_text", "value_text")
        .dropna(subset=[SERIES_CODE, TIMESTAMP])
    )


def accept_batch(rows: DataFrame) -> DataFrame:
    """Rows of the series that have data and no infinite or future value."""
    failing = value_failures(rows).filter(F.col("check") != "timestamp is repeated")
    return rows.join(failing.select(SERIES_CODE).distinct(), SERIES_CODE, "left_anti")


def screen_batch(
    rows: DataFrame, source: str, *, hold: str = BY_SERIES, now: Column | None = None
) -> DataFrame:
    """Every text row of drop files, parsed, and the ``reason`` it is held back (NULL: accepted).

    ``hold='series'`` accepts what ``accept_batch`` does: one infinite or future value holds back
    its whole series. ``hold='row'`` holds back the failing rows alone.
    """
    if hold not in (BY_SERIES, BY_ROW):
        raise ValueError(f"hold must be {BY_SERIES!r} or {BY_ROW!r}, got {hold!r}")
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    own = (
        F.when(F.col(SERIES_CODE).isNull(), "series_code is missing")
        .when(F.col(TIMESTAMP).isNull(), "timestamp is not readable")
        .when(F.col(VALUE).isNotNull() & ~is_finite(F.col(VALUE)), "value is not finite")
        .when(F.col(TIMESTAMP) > now, "timestamp is in the future")
    )
    parsed = _parsed(rows, source)
    if hold == BY_ROW:
        return parsed.withColumn("reason", own)
    usable = parsed.dropna(subset=[SERIES_CODE, TIMESTAMP])
    failing = value_failures(usable, now).filter(F.col("check") != "timestamp is repeated")
    # At most three checks per series.
    named = failing.groupBy(SERIES_CODE).agg(
        F.array_join(F.sort_array(F.collect_set("check")), ", ").alias("_checks")
    )
    held = F.concat(F.lit("series held back: "), F.col("_checks"))
    return (
        parsed.join(named, SERIES_CODE, "left")
        .withColumn("reason", F.coalesce(own, held))
        .drop("_checks")
    )


def rejected_rows(api: DataAPI) -> DataFrame:
    """Rows that were held back, with reason and micro-batch. A repeated batch writes them again
    under the same number."""
    return api.lake.table("main", REJECTS_TABLE).read()


def rejected_counts(api: DataAPI) -> DataFrame:
    """(batch, ticker_source, reason, n) of the rows that were held back."""
    return rejected_rows(api).groupBy("batch", TICKER_SOURCE, "reason").agg(F.count("*").alias("n"))


def start_ingest(
    spark: SparkSession,
    api: DataAPI,
    folder: str,
    source: str,
    *,
    checkpoint: str | None = None,
    files_per_batch: int = 1000,
    once: bool = False,
    hold: str = BY_SERIES,
) -> StreamingQuery:
    """Follow a folder of CSV drops. ``once`` drains what is there and stops.

    Rows that are held back (see ``screen_batch`` for ``hold``) go to ``rejected_values``.
    """
    drops = (
        spark.readStream.schema(FILE_SCHEMA)
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )

    def write(batch: DataFrame, number: int) -> None:
        # One moment for both reads of the batch, so that each row goes to exactly one table.
        moment = batch.sparkSession.range(1).select(F.current_timestamp().cast("timestamp_ntz").cast("string"))
        now = F.lit(moment.first()[0]).cast("timestamp_ntz")
        screened = screen_batch(batch, source, hold=hold, now=now)
        rejected = screened.filter("reason IS NOT NULL").withColumn("batch", F.lit(number).cast("long"))
        api.lake.table("main", REJECTS_TABLE).append(rejected)
        api.write_values(
            screened.filter("reason IS NULL").select(SERIES_CODE, TIMESTAMP, VALUE, TICKER_SOURCE)
        )

    writer = drops.writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint or f"{shared_dir(spark)}/ingest-{normalize_source(source)}"
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
