"""Fixed-length row windows: forward fill, realised volatility, log-return volatility.

Two situations, two plans. On a business-day grid a series has at most one row per day, so a
window partitioned by series holds some 26,000 rows per century and needs nothing special.
On raw timestamps a series has no such bound: its length is counted, and a long one is cut by
:func:`chunk_rows` into pieces that carry copies of the few rows before them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from serieslake.functions.numeric import is_finite
from serieslake.schema import SERIES_CODE, TIMESTAMP, VALUE
from serieslake.session import cut_lineage

CHUNK = "_chunk"
IS_COPY = "_is_copy"
POSITION = "_position"


def row_positions(
    frame: DataFrame, keys: Sequence[str], order: str = TIMESTAMP, bucket: str = "day"
) -> DataFrame:
    """Position of each row within its key, counted without putting a key into one task.

    Rows are counted per (key, bucket of time) with map-side combine; a running sum over
    those counts (at most one per bucket) gives each bucket its offset, and only the rows of
    one bucket are ever sorted together.
    """
    bucketed = frame.withColumn("_bucket", F.date_trunc(bucket, order))
    counts = bucketed.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(order)
    return (
        bucketed.join(offsets, [*keys, "_bucket"])
        .withColumn(POSITION, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_offset")
    )


def chunk_rows(
    frame: DataFrame,
    keys: Sequence[str],
    preceding: int,
    *,
    order: str = TIMESTAMP,
    chunk_size: int = 100_000,
    bucket: str = "day",
) -> tuple[DataFrame, WindowSpec]:
    """Rows cut into bounded chunks, the last ``preceding`` rows of each copied to the next.

    Returns the rows and the window to use on them. Drop the rows marked as copies after the
    window has been applied.
    """
    if chunk_size < preceding:
        raise ValueError("a chunk must be at least as long as the rows it looks back on")
    placed = row_positions(frame, keys, order, bucket)
    chunk = F.floor(F.col(POSITION) / chunk_size)
    is_tail = (F.col(POSITION) % chunk_size) >= chunk_size - preceding
    targets = F.when(is_tail, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    rows = placed.select("*", F.posexplode(targets).alias("_copy", CHUNK)).withColumn(
        IS_COPY, F.col("_copy") == 1
    )
    return rows.drop("_copy"), W.partitionBy(*keys, CHUNK).orderBy(POSITION)


def forward_fill(value: Column, window: WindowSpec, limit: int | None = None) -> Column:
    """Last known value, looking back at most ``limit`` rows (no bound when None)."""
    start = W.unboundedPreceding if limit is None else -limit
    return F.last(value, ignorenulls=True).over(window.rowsBetween(start, 0))


def rolling_mean(value: Column, window: WindowSpec, length: int) -> Column:
    """Mean of the last ``length`` rows, NULL until that many values are known."""
    frame = window.rowsBetween(1 - length, 0)
    return F.when(F.count(value).over(frame) == length, F.avg(value).over(frame))


def realized_volatility(
    frame: DataFrame,
    *,
    value: str = VALUE,
    keys: Sequence[str] = (SERIES_CODE,),
    order: str = TIMESTAMP,
    length: int = 20,
    name: str = "realized_volatility",
) -> DataFrame:
    """Mean absolute daily change over the last ``length`` rows of a business-day grid.

    Inner gaps count as "no change"; a change from zero is missing.
    """
    window = W.partitionBy(*keys).orderBy(order)
    padded = frame.withColumn("_level", forward_fill(F.col(value), window))
    previous = F.lag("_level").over(window)
    moves = padded.withColumn(
        "_move", F.when(previous != 0, F.abs(F.col("_level") / previous - 1))
    )
    return moves.withColumn(name, rolling_mean(F.col("_move"), window, length)).drop(
        "_level", "_move"
    )


def log_return_volatility(
    frame: DataFrame, *, length: int = 21, periods_per_year: float = 252.0, chunk_size: int = 100_000
) -> DataFrame:
    """Annualised standard deviation of log returns, in percent.

    Only positive finite levels take part, gaps are closed before differencing, and rows
    without a full window are dropped. Input: one row per (series, timestamp).

    The levels are written out first: they are read more than once, and how long the longest
    series is decides whether series must be cut into chunks.
    """
    levels = frame.filter(is_finite(F.col(VALUE)) & (F.col(VALUE) > 0)).select(
        SERIES_CODE, TIMESTAMP, F.ln(VALUE).alias("_log")
    )
    usable = cut_lineage(levels, "levels")
    lengths = usable.groupBy(SERIES_CODE).agg(F.count("*").alias("n"))
    longest = lengths.agg(F.max("n")).first()[0] or 0
    if longest > chunk_size:
        rows, window = chunk_rows(usable, [SERIES_CODE], length, chunk_size=chunk_size)
    else:
        rows = usable.withColumn(IS_COPY, F.lit(False))
        window = W.partitionBy(SERIES_CODE).orderBy(TIMESTAMP)
    returns = rows.withColumn("_return", F.col("_log") - F.lag("_log").over(window))
    span = window.rowsBetween(1 - length, 0)
    deviation = F.when(
        F.count("_return").over(span) == length, F.stddev_samp("_return").over(span)
    )
    scaled = deviation * F.sqrt(F.lit(periods_per_year)) * 100.0
    return (
        returns.select(SERIES_CODE, TIMESTAMP, scaled.alias(VALUE), IS_COPY)
        .filter(~F.col(IS_COPY) & F.col(VALUE).isNotNull() & is_finite(F.col(VALUE)))
        .drop(IS_COPY)
    )
