"""Last known values over groups of any size: forward fills and as-of joins.

"The last known value" is an associative scan: the last of two neighbouring stretches is that of the
second, or else that of the first. Rows are dealt by ranges of (group, order), so a hot series spreads
over many tasks; each range scans its own rows, the ranges' last values are scanned next (one row per
range and group), and a range that begins without a value takes the one carried to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from serieslake.session import cut_lineage


def carry_last(
    frame: DataFrame, group: str, order: Sequence[Column], known: Column, payload: Column, name: str
) -> DataFrame:
    """Adds ``name``: ``payload`` of the last row of the group, up to this one, that is ``known`` (null
    before the first), and ``{name}_since``: the rows since then (0 on the row itself).

    Group must not be null. The dealt rows are written to the shared folder, which fixes their order;
    rows that tie in every order column stand in any order.
    """
    placed = cut_lineage(
        frame.withColumn("_payload", F.when(known, payload))
        .withColumn("_known", F.coalesce(known, F.lit(False)))
        .repartitionByRange(F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "ordered",
    )
    # A range's rows of one group follow one another, so places in it are differences of numbers.
    seen = F.when(F.col("_known"), F.struct("_at", "_payload"))
    ranges = placed.groupBy("_part", group).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"), F.max_by(seen, F.when(F.col("_known"), F.col("_at"))).alias("_last")
    )
    earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    place = F.col("_before") + F.col("_last._at") - F.col("_first")
    carried = F.when(F.col("_last").isNotNull(), F.struct(place.alias("place"), F.col("_last._payload").alias("payload")))
    ranges = ranges.withColumn("_carried", F.last(carried, ignorenulls=True).over(earlier))
    upto = W.partitionBy("_part", group).orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)
    scanned = placed.withColumn("_mine", F.last(seen, ignorenulls=True).over(upto)).join(
        ranges.select("_part", group, "_first", "_before", "_carried"), ["_part", group]
    )
    here = F.col("_before") - F.col("_first")
    own = F.struct((here + F.col("_mine._at")).alias("place"), F.col("_mine._payload").alias("payload"))
    return (
        scanned.withColumn("_found", F.when(F.col("_mine").isNotNull(), own).otherwise(F.col("_carried")))
        .withColumn(name, F.col("_found.payload"))
        .withColumn(f"{name}_since", here + F.col("_at") - F.col("_found.place"))
        .drop("_payload", "_known", "_part", "_at", "_mine", "_first", "_before", "_carried", "_found")
    )


def fill_series(
    frame: DataFrame, group: str, order: Sequence[Column], value: str, *, limit: int | None = None
) -> DataFrame:
    """Rows with gaps of ``value`` filled by the last known one, at most ``limit`` rows back."""
    known = F.col(value).isNotNull()
    filled = carry_last(frame, group, order, known, F.col(value), "_last")
    near = F.lit(True) if limit is None else F.col("_last_since") <= limit
    return filled.withColumn(value, F.when(near, F.col("_last"))).drop("_last", "_last_since")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    group: str,
    time: str,
    values: Sequence[str],
    *,
    tie: Sequence[Column] = (),
    tolerance: Column | None = None,
) -> DataFrame:
    """``left`` with ``values`` of the newest row of ``right`` in the same group at or before its time.

    Of right rows at the same time the last in the order of ``tie`` counts; ``tolerance`` (an interval)
    limits their age. Left rows without one keep NULL; every left row stays once.
    """
    own = [c for c in left.columns if c not in (group, time)]
    probes = left.select(group, time, F.lit(1).alias("_side"), F.struct(*own).alias("_own") if own else F.lit(None).alias("_own"))
    known = right.select(
        group, time, F.lit(0).alias("_side"), F.struct(F.col(time).alias("_seen"), *values).alias("_values"), *[t.alias(f"_tie{k}") for k, t in enumerate(tie)]
    )
    order = [F.col(time), F.col("_side"), *[F.col(f"_tie{k}") for k in range(len(tie))]]
    line = known.unionByName(probes, allowMissingColumns=True)
    found = carry_last(line, group, order, F.col("_side") == 0, F.col("_values"), "_newest").filter("_side = 1")
    fresh = F.col("_newest").isNotNull()
    if tolerance is not None:
        fresh = fresh & (F.col("_newest._seen") + tolerance >= F.col(time))
    return found.select(
        group,
        time,
        *([F.col(f"_own.{c}").alias(c) for c in own]),
        *[F.when(fresh, F.col(f"_newest.{name}")).alias(name) for name in values],
    )
