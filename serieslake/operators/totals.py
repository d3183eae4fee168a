"""Running totals over groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from serieslake.session import cut_lineage


def running_totals(
    frame: DataFrame, group: str, order: list[Column], value: str, total: str
) -> DataFrame:
    """Adds ``total``: the sum of ``value`` over the rows of the same group that come earlier.

    Rows are dealt by ranges of (group, order), so a hot group spreads over many tasks. Sums run
    inside each range; the ranges' own sums, one row per range and group, give the offsets. The
    dealt rows are written to the shared folder, which fixes their order. Group must not be null;
    rows that tie in every order column are interchangeable.
    """
    placed = cut_lineage(
        frame.repartitionByRange(F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "ordered",
    )
    ranges = placed.groupBy("_part", group).agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.select(
        "_part", group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")
    )
    inside = W.partitionBy("_part", group).orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, ["_part", group])
        .withColumn(total, F.col("_offset") + F.col("_inside"))
        .drop("_part", "_at", "_inside", "_offset")
    )
