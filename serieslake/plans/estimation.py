"""Rolling regressions of a rate on its drivers, as one Spark job over pairs and dates.

A fit is one row keyed (pair, as_of), whatever the number of dates: sums over its window come from
running totals (:mod:`serieslake.plans.windows`), coefficients, the sign check and the refit from
sweeps over them (:mod:`serieslake.plans.sweep`), the unit-root test of its residuals from lagged
products (:mod:`serieslake.plans.unitroot`). No window's rows are copied.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serieslake.functions.numeric import log_level, to_level
from serieslake.plans.drivers import RATE, by_universe
from serieslake.plans.regression import least_squares, unit_root_test
from serieslake.plans.sweep import estimate_columns, solve_fits
from serieslake.plans.unitroot import LEVELS, TEST_FIELDS, residual_tests
from serieslake.plans.universes import Universe
from serieslake.plans.windows import (
    KEYS,
    MONTH_UNITS,
    cells,
    listed_dates,
    month_key,
    window_sums,
)
from serieslake.schema import SERIES_CODE
from serieslake.session import cut_lineage


def estimate_schema(drivers: Sequence[str]) -> T.StructType:
    double, text = T.DoubleType(), T.StringType()
    fields = [
        (SERIES_CODE, text),
        ("universe", text),
        ("as_of", T.DateType()),
        ("status", text),
        ("is_logged", T.BooleanType()),
        ("current_rate", double),
        ("fitted_value", double),
        ("actual_value", double),
        ("residual_std", double),
        ("z_score", double),
        ("r_squared", double),
        ("n_obs", T.LongType()),
        ("dropped_variables", text),
    ]
    for prefix in ("coefficient", "standard_error", "p_value"):
        fields += [(f"{prefix}_{name}", double) for name in ("const", *drivers)]
    fields += [
        ("cointegration_passed", T.BooleanType()),
        ("cointegration_p_value", double),
        ("cointegration_statistic", double),
        *[(f"critical_{level.rstrip('%')}pct", double) for level in LEVELS],
        ("cointegration_n_obs", T.LongType()),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def assign_dates(
    features: DataFrame, months: int | None, fit_dates: Sequence[date] | None
) -> DataFrame:
    """Each feature row once per fit date whose trailing window holds it.

    Fit dates are a short literal list (the lookback of a run), so the assignment is an array
    expression per row, not a join. Without a list every pair uses its own last day.
    """
    day = F.col("day")
    if fit_dates is None:
        own = F.max("day").over(W.partitionBy(SERIES_CODE, "universe"))
        dates = F.array(own)
    else:
        dates = F.array(*[F.lit(d).cast("date") for d in fit_dates])

    def holds(as_of: Column) -> Column:
        inside = day <= as_of
        return inside & (day > F.add_months(as_of, -months)) if months else inside

    return features.withColumn("_dates", dates).select(
        "*", F.explode(F.filter("_dates", holds)).alias("as_of")
    ).drop("_dates")


def all_drivers(universes: Mapping[str, Universe]) -> list[str]:
    """The drivers of all universes, each once."""
    return list(dict.fromkeys(name for universe in universes.values() for name in universe.drivers))


def estimate(
    features: DataFrame,
    universe: Universe | Mapping[str, Universe],
    *,
    fit_dates: Sequence[date] | Mapping[str, Sequence[date]] | None = None,
    test_dates: Sequence[date] | Mapping[str, Sequence[date]] | None = None,
    every_day: bool = False,
) -> DataFrame:
    """Estimates for every (pair, as_of) of one or several universes; pairs without enough data have
    another status.

    Fits are at the given dates (of all universes, or by universe), at each pair's own last day, or at
    every day of each pair; all come from the same sums over windows. ``test_dates`` limits the
    unit-root test to those dates, on which a pair is tested only when that day is on its own grid;
    None tests every fit.
    """
    universes = {universe.name: universe} if isinstance(universe, Universe) else universe
    drivers = all_drivers(universes)
    months = by_universe("window_months", universes)
    chosen = features.filter(F.col("universe").isin(*universes))
    rows = cut_lineage(cells(chosen, drivers), "cells")
    sums = window_sums(rows, drivers, months, fit_dates=fit_dates, every_day=every_day)
    solved = solve_fits(sums, universes, drivers)
    numbers = estimate_columns(
        solved.withColumn("on_grid", F.col("newest.day") == F.col("as_of")), drivers, "on_grid"
    )
    tested = F.lit(True)
    if test_dates is not None:
        tested = F.array_contains(listed_dates(test_dates), F.col("as_of")) & F.col("on_grid")
    numbers = numbers.withColumn("tested", tested)
    schema = estimate_schema(drivers)
    names = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    if test_dates is not None and not test_dates:
        blank = {name: F.lit(None).cast(kind) for name, kind in TEST_FIELDS}
        return numbers.withColumns(blank).select(*names)
    numbers = cut_lineage(numbers, "fits")
    enough = numbers.filter(
        F.col("tested") & (F.col("first_n") >= by_universe("min_observations", universes))
    )
    tests = residual_tests(rows, enough, drivers, months)
    low = F.col("cointegration_p_value") <= by_universe("cointegration_significance", universes)
    passed = F.when(F.col("tested"), F.coalesce(low, F.lit(False)))
    return numbers.join(tests, KEYS, "left").withColumn("cointegration_passed", passed).select(*names)


def response(is_logged: Column) -> Column:
    """The dependent variable: log rate or rate."""
    return F.when(is_logged, log_level(F.col(RATE))).otherwise(F.col(RATE))


def fitted_rows(
    features: DataFrame,
    estimates: DataFrame,
    universe: Universe,
    *,
    fit_dates: Sequence[date] | None = None,
) -> DataFrame:
    """Windowed rows of every fit: response, fitted value, residual, band and fair value."""
    drivers = list(universe.drivers)
    rows = features.filter(F.col("universe") == universe.name).drop("is_logged")
    assigned = assign_dates(rows, universe.window_months, fit_dates)
    solved = estimates.filter(F.col("status") == "ok").select(
        *KEYS,
        "is_logged",
        "residual_std",
        *[f"coefficient_{name}" for name in ("const", *drivers)],
    )
    joined = assigned.join(solved, KEYS)
    fitted = F.col("coefficient_const")
    complete = response(F.col("is_logged")).isNotNull()
    for name in drivers:
        weight = F.col(f"coefficient_{name}")
        fitted = fitted + F.when(weight.isNull(), F.lit(0.0)).otherwise(weight * F.col(name))
        complete = complete & (weight.isNull() | F.col(name).isNotNull())
    band = F.lit(universe.z_threshold) * F.col("residual_std")
    shaped = joined.filter(complete).select(
        *KEYS,
        F.col("day").alias("date"),
        "is_logged",
        F.col(RATE).alias("spot"),
        *drivers,
        response(F.col("is_logged")).alias("response"),
        fitted.alias("fitted"),
        band.alias("_band"),
    )
    return shaped.select(
        *KEYS,
        "date",
        "spot",
        *drivers,
        "response",
        "fitted",
        to_level(F.col("fitted"), F.col("is_logged")).alias("fair_value"),
        (F.col("response") - F.col("fitted")).alias("residual"),
        (F.col("fitted") + F.col("_band")).alias("upper_bound"),
        (F.col("fitted") - F.col("_band")).alias("lower_bound"),
    )


def design_rows(
    features: DataFrame, estimates: DataFrame, universe: Universe, **kwargs
) -> DataFrame:
    """The regression's design matrix as rows: a constant and the drivers that were kept."""
    rows = fitted_rows(features, estimates, universe, **kwargs)
    dropped = estimates.select(*KEYS, F.split("dropped_variables", ",").alias("_dropped"))
    return rows.join(dropped, KEYS).select(
        *KEYS,
        "date",
        F.lit(1.0).alias("const"),
        *[
            F.when(~F.array_contains("_dropped", name), F.col(name)).alias(name)
            for name in universe.drivers
        ],
    )


def pairwise_cointegration(
    frame: DataFrame,
    y: str,
    x: str,
    *,
    keys: Sequence[str],
    as_of: date,
    day: str = "day",
    significance: float = 0.05,
    min_observations: int = 20,
) -> DataFrame:
    """Two-series cointegration test per key over all complete days up to ``as_of``.

    Days of a business calendar bound a key's rows, so its series fits one packed row.
    """
    rows = frame.filter(F.col(day) <= F.lit(as_of).cast("date")).dropna(subset=[y, x])
    packed = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(day).alias("d"), F.col(y).alias("y"), F.col(x).alias("x")))).alias("w")
    )
    packed = packed.select(*keys, F.col("w.y").alias("y"), F.col("w.x").alias("x"))
    schema = T.StructType(
        [
            *[f for f in frame.schema if f.name in keys],
            T.StructField("status", T.StringType()),
            T.StructField("passed", T.BooleanType()),
            T.StructField("p_value", T.DoubleType()),
            T.StructField("statistic", T.DoubleType()),
            T.StructField("n_obs", T.LongType()),
        ]
    )

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for window in batch.to_dict("records"):
                left, right = (np.array(window[name], dtype=float) for name in ("y", "x"))
                row = {key: window[key] for key in keys} | {"n_obs": len(left)}
                if len(left) < min_observations:
                    row |= {"status": "insufficient_data", "passed": False}
                else:
                    root = unit_root_test(least_squares(left, right[:, None]).residuals)
                    row |= {
                        "status": "ok",
                        "passed": bool(root.p_value <= significance),
                        "p_value": root.p_value,
                        "statistic": root.statistic,
                    }
                rows.append(row)
            yield pd.DataFrame(rows, columns=schema.names)

    return packed.mapInPandas(test, schema)


def moment_columns(y: str, xs: Sequence[str]) -> list[Column]:
    """Sufficient statistics of a regression: n, means and (population) covariances.

    Covariance aggregates are centred and merge exactly, so they combine on the map side and
    do not cancel the way raw sums of products do.
    """
    names = [y, *xs]
    columns = [F.count(y).alias("n")]
    columns += [F.avg(name).alias(f"mean_{name}") for name in names]
    columns += [
        F.covar_pop(a, b).alias(f"cov_{a}_{b}") for i, a in enumerate(names) for b in names[i:]
    ]
    return columns


def complete_rows(frame: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    return frame.dropna(subset=[y, *xs])


def moments(frame: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str]) -> DataFrame:
    """Sufficient statistics per key, by an ordinary aggregate with map-side combine."""
    return complete_rows(frame, y, xs).groupBy(*keys).agg(*moment_columns(y, xs))


def rolling_moments(
    frame: DataFrame,
    keys: Sequence[str],
    y: str,
    xs: Sequence[str],
    months: int,
    *,
    day: str = "day",
) -> DataFrame:
    """Sufficient statistics of the trailing month window of every day.

    One shuffle and no copies of rows, whatever the number of dates: a window's sums are the
    difference of two running totals of cells centred by the key's first values. A key's rows are bounded
    by the calendar.
    """
    names = [y, *xs]
    rows = complete_rows(frame, y, xs).withColumn("_key", month_key(F.col(day)).cast("long"))
    line = W.partitionBy(*keys).orderBy("_key")
    centred = rows.select(
        *keys, day, *names, "_key", *[F.first(name).over(line).alias(f"_mid_{name}") for name in names]
    ).withColumns({f"_at_{name}": F.col(name) - F.col(f"_mid_{name}") for name in names})
    # Both frames only grow, so every total is added up once per row.
    upto = line.rangeBetween(W.unboundedPreceding, W.currentRow)
    before = line.rangeBetween(W.unboundedPreceding, -MONTH_UNITS * months)

    def inside(value: Column) -> Column:
        return F.sum(value).over(upto) - F.coalesce(F.sum(value).over(before), F.lit(0.0))

    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    summed = centred.select(
        *keys,
        day,
        *names,
        *[f"_mid_{name}" for name in names],
        inside(F.lit(1.0)).alias("_n"),
        *[inside(F.col(f"_at_{name}")).alias(f"_s_{name}") for name in names],
        *[inside(F.col(f"_at_{a}") * F.col(f"_at_{b}")).alias(f"_s_{a}_{b}") for a, b in pairs],
    )
    n = F.col("_n")
    return summed.select(
        *keys,
        day,
        *names,
        n.cast("long").alias("n"),
        *[(F.col(f"_mid_{name}") + F.col(f"_s_{name}") / n).alias(f"mean_{name}") for name in names],
        *[
            (F.col(f"_s_{a}_{b}") / n - F.col(f"_s_{a}") * F.col(f"_s_{b}") / n / n).alias(f"cov_{a}_{b}")
            for a, b in pairs
        ],
    )


def solve_moments(
    frame: DataFrame, y: str, xs: Sequence[str], *, min_observations: int = 1
) -> DataFrame:
    """Coefficients, residual spread and r-squared from sufficient statistics, in batches.

    Needs the columns of :func:`moments` or :func:`rolling_moments`; other columns pass
    through. Solved with a pseudo-inverse, as the row-level path does.
    """
    names = list(xs)
    added = [f"coefficient_{name}" for name in ("const", *names)] + ["residual_std", "r_squared"]
    statistics = {"n", *[f"mean_{n}" for n in (y, *names)]} | {
        f"cov_{a}_{b}" for i, a in enumerate([y, *names]) for b in [y, *names][i:]
    }
    passed = [f for f in frame.schema if f.name not in statistics or f.name == "n"]
    schema = T.StructType([*passed, *[T.StructField(a, T.DoubleType()) for a in added]])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["n"] >= min_observations].reset_index(drop=True)
            if batch.empty:
                continue
            k = len(names)
            within = np.empty((len(batch), k, k))
            for i, a in enumerate(names):
                for j, b in enumerate(names[i:], start=i):
                    within[:, i, j] = within[:, j, i] = batch[f"cov_{a}_{b}"]
            across = batch[[f"cov_{y}_{a}" for a in names]].to_numpy(float)
            scale = np.sqrt(np.maximum(np.einsum("nii->ni", within), 1e-300))
            scaled = within / scale[:, :, None] / scale[:, None, :]
            slopes = np.einsum(
                "nij,nj->ni", np.linalg.pinv(scaled, hermitian=True), across / scale
            ) / scale
            means = batch[[f"mean_{a}" for a in names]].to_numpy(float)
            spread = batch[f"cov_{y}_{y}"].to_numpy(float)
            explained = (slopes * across).sum(axis=1)
            left = np.maximum(spread - explained, 0.0)
            out = batch[[f.name for f in passed]].copy()
            out["coefficient_const"] = batch[f"mean_{y}"].to_numpy(float) - (slopes * means).sum(1)
            for i, name in enumerate(names):
                out[f"coefficient_{name}"] = slopes[:, i]
            out["residual_std"] = np.sqrt(left)
            out["r_squared"] = np.where(spread > 0, 1.0 - left / np.where(spread > 0, spread, 1), np.nan)
            yield out[schema.names]

    return frame.mapInPandas(solve, schema)
