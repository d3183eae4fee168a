"""Chart-ready aggregates. Data only; drawing is left to whatever reads them.

Inputs are long rows (series_code, timestamp, value) with one row per key, as
:func:`serieslake.operators.values.last_wins` returns them.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator, Mapping, Sequence
from datetime import date, datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from serieslake.functions.dates import period_label
from serieslake.functions.text import day_label, range_label, tenor_months
from serieslake.operators.gram import pearson_cells
from serieslake.operators.reshape import pivot_values
from serieslake.operators.totals import running_totals
from serieslake.operators.values import last_wins
from serieslake.schema import SERIES_CODE, TIMESTAMP, VALUE
from serieslake.session import cut_lineage

#: Accuracy of the quantile sketch that narrows an exact percentile down, and the number of
#: rows from which narrowing pays; below it a series is sorted whole.
SKETCH_ACCURACY = 10_000
SKETCH_ROWS = 10 * SKETCH_ACCURACY


def _known(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col(VALUE).isNotNull())


def line_data(frame: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Wide values with gaps left NULL."""
    return pivot_values(frame, codes)


def scatter_pairs(frame: DataFrame, x: str, y: str) -> DataFrame:
    """Timestamps on which both series are known."""
    wide = pivot_values(frame, [x, y], sort=False)
    return wide.select(TIMESTAMP, F.col(f"`{x}`").alias("x"), F.col(f"`{y}`").alias("y")).dropna()


def histogram(frame: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width counts per series between its minimum and maximum; empty bins are listed.

    A series of one repeated value gets a range of one around it. The last bin is closed.
    """
    known = _known(frame)
    ends = known.groupBy(SERIES_CODE).agg(F.min(VALUE).alias("a"), F.max(VALUE).alias("b"))
    # Written out: its real size then lets the join with the values avoid a shuffle.
    limits = cut_lineage(ends, "limits")
    flat = F.col("a") == F.col("b")
    limits = limits.select(
        SERIES_CODE,
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("low"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("high"),
    )
    step = (F.col("high") - F.col("low")) / F.lit(bins)
    index = F.least(F.floor((F.col(VALUE) - F.col("low")) / step), F.lit(bins - 1))
    counts = (
        known.join(limits, SERIES_CODE)
        .groupBy(SERIES_CODE, index.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    edges = limits.select(
        SERIES_CODE, "low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    low = F.col("low") + F.col("bin") * step
    high = F.when(F.col("bin") == bins - 1, F.col("high")).otherwise(
        F.col("low") + (F.col("bin") + 1) * step
    )
    return edges.join(counts, [SERIES_CODE, "bin"], "left").select(
        SERIES_CODE,
        "bin",
        low.alias("bin_low"),
        high.alias("bin_high"),
        range_label(low, high).alias("label"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def exact_percentiles(frame: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """Linearly interpolated percentiles per series, exact, whatever the size of a series.

    The built-in exact percentile holds every distinct value of a group in one task. Here a
    mergeable sketch brackets each percentile's rank within a known error, an aggregate counts
    the values below each bracket, and only the distinct values inside one are sorted.
    """
    known = _known(frame)
    slack = 3.0 / SKETCH_ACCURACY
    names = list(quantiles)
    low_at = [max(0.0, quantiles[name] - slack) for name in names]
    high_at = [min(1.0, quantiles[name] + slack) for name in names]
    sketch = known.groupBy(SERIES_CODE).agg(
        F.count("*").alias("_n"),
        F.min(VALUE).alias("_min"),
        F.max(VALUE).alias("_max"),
        F.percentile_approx(VALUE, low_at + high_at, SKETCH_ACCURACY).alias("_cuts"),
    )
    sketch = cut_lineage(sketch, "sketch")
    is_small = F.col("_n") <= SKETCH_ROWS
    brackets = sketch.select(
        SERIES_CODE,
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("name"),
                    (F.lit(quantiles[name]) * (F.col("_n") - 1)).alias("rank"),
                    F.when(is_small | F.lit(low_at[i] <= 0), F.col("_min"))
                    .otherwise(F.col("_cuts")[i])
                    .alias("low"),
                    F.when(is_small | F.lit(high_at[i] >= 1), F.col("_max"))
                    .otherwise(F.col("_cuts")[i + len(names)])
                    .alias("high"),
                )
                for i, name in enumerate(names)
            ]
        ).alias("_brackets"),
    )
    placed = known.select(SERIES_CODE, VALUE).join(brackets, SERIES_CODE)
    below = (
        placed.groupBy(SERIES_CODE)
        .agg(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("name"),
                        F.count_if(F.col(VALUE) < F.col("_brackets")[i]["low"]).alias("below"),
                    )
                    for i, name in enumerate(names)
                ]
            ).alias("_below")
        )
        .select(SERIES_CODE, F.inline("_below"))
    )
    inside = (
        placed.select(SERIES_CODE, VALUE, F.explode("_brackets").alias("b"))
        .filter(F.col(VALUE).between(F.col("b.low"), F.col("b.high")))
        .groupBy(SERIES_CODE, F.col("b.name").alias("name"), F.col("b.rank").alias("rank"), VALUE)
        .agg(F.count("*").alias("n"))
        .join(below, [SERIES_CODE, "name"])
    )
    running = W.partitionBy(SERIES_CODE, "name").orderBy(VALUE)
    upto = F.col("below") + F.sum("n").over(running.rowsBetween(W.unboundedPreceding, 0))
    ranked = inside.withColumn("_upto", upto).withColumn("_from", F.col("_upto") - F.col("n"))
    floor, ceil = F.floor("rank"), F.ceil("rank")
    at_floor = F.max(F.when((F.col("_from") <= floor) & (floor < F.col("_upto")), F.col(VALUE)))
    at_ceil = F.max(F.when((F.col("_from") <= ceil) & (ceil < F.col("_upto")), F.col(VALUE)))
    picked = ranked.groupBy(SERIES_CODE, "name", "rank").agg(
        at_floor.alias("lo"), at_ceil.alias("hi")
    )
    value = F.col("lo") + (F.col("rank") - F.floor("rank")) * (F.col("hi") - F.col("lo"))
    cells = [F.max(F.when(F.col("name") == name, F.col("_v"))).alias(name) for name in names]
    return picked.withColumn("_v", value).groupBy(SERIES_CODE).agg(*cells)


def boxplot(frame: DataFrame) -> DataFrame:
    """Five-number summary per series."""
    quartiles = exact_percentiles(frame, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    ends = _known(frame).groupBy(SERIES_CODE).agg(F.min(VALUE).alias("low"), F.max(VALUE).alias("high"))
    return ends.join(quartiles, SERIES_CODE).select(
        SERIES_CODE, "low", "q1", "median", "q3", "high"
    )


def _kendall(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Kendall's tau-b per row of packed samples, counting inversions in n log n."""
    for batch in groups:
        taus = []
        for xs, ys in zip(batch["xs"], batch["ys"]):
            x, y = np.asarray(xs), np.asarray(ys)
            n = len(x)
            order = np.lexsort((y, x))
            seen: list[float] = []
            discordant = 0
            for i, value in enumerate(y[order]):
                discordant += i - bisect_right(seen, value)
                insort(seen, value)

            def tied(*columns: np.ndarray) -> int:
                _, counts = np.unique(np.stack(columns), axis=1, return_counts=True)
                return int((counts * (counts - 1) // 2).sum())

            total = n * (n - 1) // 2
            tx, ty, txy = tied(x), tied(y), tied(x, y)
            scale = np.sqrt(float(total - tx) * float(total - ty))
            both = total - tx - ty + txy - 2 * discordant
            taus.append(both / scale if scale else None)
        yield batch[["series_x", "series_y"]].assign(correlation=pd.Series(taus, dtype="float64"))


def _spearman(samples: DataFrame) -> DataFrame:
    """Correlation of the average ranks of every (series_x, series_y), no task holding a pair.

    A rank comes from the number of smaller values: a running total over counts of distinct values.
    """
    pair = F.struct("series_x", "series_y").alias("pair")
    points = cut_lineage(samples.groupBy(pair, "x", "y").agg(F.count("*").alias("n")), "points")
    ranked = points
    for name in ("x", "y"):
        counts = points.groupBy("pair", name).agg(F.sum("n").alias("same"))
        ranks = running_totals(counts, "pair", [F.col(name)], "same", "below").select(
            "pair", name, (F.col("below") + (F.col("same") + 1) / 2.0).alias(f"r{name}")
        )
        ranked = ranked.join(ranks, ["pair", name])
    # The mean of average ranks is known, so sums of deviations do.
    sizes = points.groupBy("pair").agg(((F.sum("n") + 1) / 2.0).alias("mean"))
    n, x, y = F.col("n"), F.col("rx") - F.col("mean"), F.col("ry") - F.col("mean")
    sums = ranked.join(sizes, "pair").groupBy("pair").agg(
        F.sum(n * x * y).alias("xy"), F.sum(n * x * x).alias("xx"), F.sum(n * y * y).alias("yy")
    )
    scale = F.sqrt("xx") * F.sqrt("yy")
    return sums.select("pair.*", F.when(scale > 0, F.col("xy") / scale).alias("correlation"))


def correlation_matrix(
    frame: DataFrame, codes: Sequence[str], method: str = "pearson"
) -> DataFrame:
    """Pairwise-complete correlation of every pair of the listed series.

    Every method uses all timestamps on which both series are known; NaN is not known. Pearson adds up
    blocked Gram matrices (:mod:`serieslake.operators.gram`) for any number of series, Spearman takes ranks from running totals over ranges of values; Kendall
    brings a pair's complete rows together in one task.
    """
    codes = list(codes)
    if len(codes) < 2:
        raise ValueError("a correlation needs at least 2 series")
    if method == "pearson":
        half = pearson_cells(last_wins(frame), codes).drop("n")
    elif method in ("spearman", "kendall"):
        wide = pivot_values(frame.filter(~F.isnan(VALUE)), codes, sort=False)
        pairs = [(a, b) for i, a in enumerate(codes) for b in codes[i:]]
        samples = (
            wide.select(
                F.explode(
                    F.array(
                        *[
                            F.struct(
                                F.lit(a).alias("series_x"),
                                F.lit(b).alias("series_y"),
                                F.col(f"`{a}`").alias("x"),
                                F.col(f"`{b}`").alias("y"),
                            )
                            for a, b in pairs
                        ]
                    )
                ).alias("s")
            )
            .select("s.*")
            .dropna()
        )
        if method == "spearman":
            half = _spearman(samples)
        else:
            half = (
                samples.groupBy("series_x", "series_y")
                .agg(F.collect_list(F.struct("x", "y")).alias("s"))
                .select("series_x", "series_y", F.col("s.x").alias("xs"), F.col("s.y").alias("ys"))
                .mapInPandas(_kendall, "series_x string, series_y string, correlation double")
            )
    else:
        raise ValueError(f"unknown correlation method {method!r}")
    half = half.filter(F.col("correlation").isNotNull() & ~F.isnan("correlation"))
    # Both halves from one pass over the pairs.
    one, other = F.struct("series_x", "series_y"), F.struct(F.col("series_y").alias("series_x"), F.col("series_x").alias("series_y"))
    both = F.when(F.col("series_x") == F.col("series_y"), F.array(one)).otherwise(F.array(one, other))
    return half.select(F.inline(both), F.round("correlation", 4).alias("correlation"))


def calendar_values(frame: DataFrame, year: int | None = None) -> DataFrame:
    """Daily values of one year per series (each series' latest year by default), 4 decimals."""
    known = _known(frame)
    if year is None:
        latest = known.groupBy(SERIES_CODE).agg(F.max(F.year(TIMESTAMP)).alias("_year"))
        chosen = known.join(latest, SERIES_CODE).filter(F.year(TIMESTAMP) == F.col("_year"))
    else:
        chosen = known.filter(F.year(TIMESTAMP) == year)
    return chosen.select(
        SERIES_CODE,
        day_label(F.col(TIMESTAMP)).alias("day"),
        F.round(VALUE, 4).alias(VALUE),
    )


def ohlc(frame: DataFrame, freq: str = "W") -> DataFrame:
    """First, highest, lowest and last value per period, labelled by the period."""
    return (
        _known(frame)
        .groupBy(SERIES_CODE, period_label(F.col(TIMESTAMP), freq).alias("period"))
        .agg(
            F.min_by(VALUE, TIMESTAMP).alias("open"),
            F.max(VALUE).alias("high"),
            F.min(VALUE).alias("low"),
            F.max_by(VALUE, TIMESTAMP).alias("close"),
        )
    )


def seasonality(frame: DataFrame, period: str = "month") -> DataFrame:
    """Mean per series, year and calendar month (0-11) or weekday (Monday is 0)."""
    if period == "month":
        slot = F.month(TIMESTAMP) - 1
    elif period == "dayofweek":
        slot = F.weekday(TIMESTAMP)
    else:
        raise ValueError(f"no seasonality by {period!r}; choose month or dayofweek")
    return (
        _known(frame)
        .groupBy(SERIES_CODE, F.year(TIMESTAMP).alias("year"), slot.cast("int").alias("slot"))
        .agg(F.avg(VALUE).alias("mean"))
    )


def seasonality_lines(frame: DataFrame, years: Sequence[int], period: str = "month") -> DataFrame:
    """Seasonality with one column per year."""
    return (
        seasonality(frame, period)
        .groupBy(SERIES_CODE, "slot")
        .pivot("year", [int(year) for year in years])
        .agg(F.first("mean"))
        .orderBy(SERIES_CODE, "slot")
    )


def yield_curve(last_values: DataFrame, catalog: DataFrame, tenor: str = "tenor") -> DataFrame:
    """Last value by tenor, shortest first. ``last_values`` has one row per series."""
    if tenor not in catalog.columns:
        raise ValueError(f"catalog has no {tenor!r} column")
    tenors = catalog.select(SERIES_CODE, F.col(tenor).alias("tenor")).dropna()
    return (
        last_values.join(tenors, SERIES_CODE)
        .select(SERIES_CODE, "tenor", tenor_months(F.col("tenor")).alias("months"), VALUE)
        .orderBy("months", SERIES_CODE)
    )


def term_structure(
    frame: DataFrame,
    catalog: DataFrame,
    as_of_dates: Sequence[date | datetime | str],
    tenor: str = "tenor",
) -> DataFrame:
    """Last known value per series at each date, with its tenor.

    Every date is one conditional aggregate of a single scan; nothing is joined to the dates.
    """
    if tenor not in catalog.columns:
        raise ValueError(f"catalog has no {tenor!r} column")
    moments = [F.lit(str(moment)).cast("timestamp_ntz") for moment in as_of_dates]
    snapshots = _known(frame).groupBy(SERIES_CODE).agg(
        *[
            F.max_by(VALUE, F.when(F.col(TIMESTAMP) <= moment, F.col(TIMESTAMP))).alias(f"s{i}")
            for i, moment in enumerate(moments)
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(str(moment)).alias("as_of"), F.col(f"s{i}").alias(VALUE))
            for i, moment in enumerate(as_of_dates)
        ]
    )
    tenors = catalog.select(SERIES_CODE, F.col(tenor).alias("tenor")).dropna()
    return (
        snapshots.select(SERIES_CODE, F.explode(rows).alias("r"))
        .select(SERIES_CODE, "r.*")
        .join(tenors, SERIES_CODE)
        .withColumn("months", tenor_months(F.col("tenor")))
        .orderBy("as_of", "months", SERIES_CODE)
    )
