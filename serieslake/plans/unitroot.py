"""Unit-root tests of fitted residuals from lagged cross-products.

The augmented Dickey-Fuller regression at every lag count needs only sums of products of the
residual with itself a few days earlier. A residual is a fixed combination of a row's cells, so these
sums are the same combination of lagged cross-products of the cells, and those are differences of
running totals over a pair's rows: no window is copied, and no residual is computed for a second date.
Lags enter the moment matrix one at a time by sweeps, each of which gives the squared errors of one
lag count, for all dates at once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serieslake.plans.regression import critical_value, unit_root_p_value
from serieslake.plans.windows import KEYS, LEVEL, LOG, MONTH_UNITS, PAIR, month_key, value_names

LEVELS = ("1%", "5%", "10%")
#: Running totals of one lag that are small enough to keep for the next lag count.
KEPT_BYTES = 1 << 22
TEST_FIELDS = [
    ("cointegration_passed", T.BooleanType()),
    ("cointegration_p_value", T.DoubleType()),
    ("cointegration_statistic", T.DoubleType()),
    *[(f"critical_{level.rstrip('%')}pct", T.DoubleType()) for level in LEVELS],
    ("cointegration_n_obs", T.LongType()),
]


def longest_lag(count: int) -> int:
    """The most lags tried on a series of this length; negative where it is too short."""
    return min(math.ceil(12.0 * (count / 100.0) ** 0.25), count // 2 - 2)


def sweep_in(matrices: np.ndarray, place: int) -> None:
    """Sweeps one place of many matrices in place."""
    pivot = matrices[:, place, place].copy()
    row = matrices[:, place, :] / pivot[:, None]
    column = matrices[:, :, place].copy()
    matrices -= column[:, :, None] * row[:, None, :]
    matrices[:, place, :] = row
    matrices[:, :, place] = -column / pivot[:, None]
    matrices[:, place, place] = 1 / pivot


class LaggedMoments:
    """Lagged cross-products of a pair's rows, and the moments of combinations of their cells.

    ``rows`` has a row per day and a column per cell. The combination ``weights`` of the window
    ``start`` to ``stop`` is the series that is tested.
    """

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.totals: dict[int, np.ndarray] = {}
        self.sums = np.vstack([np.zeros(rows.shape[1]), np.cumsum(rows, axis=0)])

    def _total(self, lag: int) -> np.ndarray:
        """Running totals of the products of a row with the one ``lag`` days earlier."""
        if lag in self.totals:
            return self.totals[lag]
        width = self.rows.shape[1]
        products = np.zeros((len(self.rows) + 1, width, width))
        if lag < len(self.rows):
            products[lag + 1 :] = np.einsum("ti,tj->tij", self.rows[lag:], self.rows[: len(self.rows) - lag])
        total = np.cumsum(products, axis=0)
        if total.nbytes <= KEPT_BYTES:
            self.totals[lag] = total
        return total

    def matrices(self, weights: np.ndarray, start: np.ndarray, stop: np.ndarray, lags: int) -> np.ndarray:
        """For each window the moment matrix of the regression with ``lags`` lags over all days that
        have them: constant, level before, earlier changes, change."""
        span = lags + 2
        products = np.zeros((len(start), span, span))
        first = start + lags + 1
        for lag in range(span):
            total = self._total(lag)
            for near in range(span - lag):
                # Days t from first on: the values near and near + lag days before t.
                own = total[stop - near] - total[first - near]
                value = np.einsum("di,dij,dj->d", weights, own, weights)
                products[:, near, near + lag] = products[:, near + lag, near] = value
        means = np.stack(
            [np.einsum("di,di->d", weights, self.sums[stop - near] - self.sums[first - near]) for near in range(span)],
            axis=1,
        )
        # The level before is the value one day earlier, a change the difference of two.
        turn = np.zeros((lags + 2, span))
        turn[0, 1] = 1
        for k in range(1, lags + 1):
            turn[k, k], turn[k, k + 1] = 1, -1
        turn[lags + 1, 0], turn[lags + 1, 1] = 1, -1
        out = np.empty((len(start), lags + 3, lags + 3))
        out[:, 1:, 1:] = np.einsum("dkt,lt->dkl", np.einsum("ks,dst->dkt", turn, products), turn)
        out[:, 0, 1:] = out[:, 1:, 0] = np.einsum("ds,ks->dk", means, turn)
        out[:, 0, 0] = stop - first
        return out

    def tests(self, weights: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pd.DataFrame:
        """statistic, lags and n (days of the final regression) for every window."""
        count = stop - start
        out = pd.DataFrame({"statistic": np.full(len(start), np.nan), "lags": 0, "n": count})
        longest = np.array([longest_lag(n) for n in count], int)
        chosen = np.full(len(start), -1)
        for most in np.unique(longest[longest >= 0]):
            here = np.flatnonzero(longest == most)
            matrices = self.matrices(weights[here], start[here], stop[here], most)
            days = matrices[:, 0, 0].copy()
            criteria = np.full((len(here), most + 1), np.inf)
            with np.errstate(divide="ignore", invalid="ignore"):
                for place in range(most + 2):
                    sweep_in(matrices, place)
                    if place:
                        errors = np.maximum(matrices[:, -1, -1], 0.0)
                        criteria[:, place - 1] = days * np.log(errors / days) + np.log(days) * (place + 1)
            criteria[np.isnan(criteria)] = np.inf
            chosen[here] = criteria.argmin(axis=1)
        for lags in np.unique(chosen[chosen >= 0]):
            here = np.flatnonzero(chosen == lags)
            matrices = self.matrices(weights[here], start[here], stop[here], lags)
            days = matrices[:, 0, 0].copy()
            with np.errstate(divide="ignore", invalid="ignore"):
                for place in range(lags + 2):
                    sweep_in(matrices, place)
                error = np.sqrt(np.maximum(matrices[:, -1, -1], 0.0) / (days - (lags + 2)) * matrices[:, 1, 1])
                out.loc[here, "statistic"] = matrices[:, 1, -1] / error
            out.loc[here, "lags"] = lags
            out.loc[here, "n"] = days.astype(int)
        return out


def _tested(rows: pd.DataFrame, fits: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    """Tests of one pair's fits, those of the level and those of the logarithm."""
    cells = rows[names].to_numpy(float)
    keys = rows["key"].to_numpy()
    drivers = [int(place) + 1 for place in fits["places"].iloc[0]]
    found = []
    for logged, own in fits.groupby("is_logged"):
        used = [names.index(LOG if logged else LEVEL), *drivers]
        own = own.sort_values("end")
        complete = np.isfinite(cells[:, used]).all(axis=1)
        centre = np.vstack(own["centre"])[0]
        line = keys[complete]
        stop = np.searchsorted(line, own["end"].to_numpy(), side="right")
        start = np.searchsorted(line, own["start"].to_numpy(), side="right")
        beta = np.vstack(own["first_beta"])[:, [0, *[place - 1 for place in drivers]]]
        weights = np.column_stack([-beta[:, 0], np.ones(len(own)), -beta[:, 1:]])
        moved = np.column_stack([np.ones(complete.sum()), (cells - centre)[complete][:, used]])
        result = LaggedMoments(moved).tests(weights, start, stop)
        result.index = own.index
        result["count"] = stop - start
        found.append(result)
    return pd.concat(found)


def residual_tests(rows: DataFrame, fits: DataFrame, drivers: list[str], months: Column) -> DataFrame:
    """Unit-root tests of the first fits' residuals, without verdicts. ``rows`` are
    :func:`windows.cells`; ``fits`` has the keys, is_logged, first_beta, centre and places of the fits to
    test.

    A pair's rows and its fits meet in one task; both are bounded by the calendar.
    """
    schema = T.StructType(
        [f for f in fits.schema if f.name in KEYS] + [T.StructField(name, kind) for name, kind in TEST_FIELDS[1:]]
    )
    names, cells = [f.name for f in schema], value_names(drivers)

    def test(pair: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if own.empty:  # a pair with nothing to test
            kinds = {T.DoubleType(): "float64", T.LongType(): "int64"}
            return pd.DataFrame({f.name: pd.Series(dtype=kinds.get(f.dataType, "object")) for f in schema})
        result = _tested(pair.sort_values("key", ignore_index=True), own, cells)
        out = own.loc[result.index, KEYS].copy()
        statistic = result["statistic"].to_numpy()
        known = ~np.isnan(statistic)
        out["cointegration_p_value"] = [unit_root_p_value(s) for s in statistic]
        out["cointegration_statistic"] = statistic
        for level in LEVELS:
            values = np.array([critical_value(level, n) for n in result["n"]])
            out[f"critical_{level.rstrip('%')}pct"] = np.where(known, values, np.nan)
        out["cointegration_n_obs"] = result["count"].astype("int64")
        return out[names]

    end = month_key(F.col("as_of"))
    marked = fits.select(
        *KEYS, end.alias("end"), (end - MONTH_UNITS * months).alias("start"), "is_logged", "first_beta", "centre", "places"
    )
    slim = rows.select(*PAIR, "key", *cells)
    found = slim.groupBy(*PAIR).cogroup(marked.groupBy(*PAIR)).applyInPandas(test, schema)
    return found.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if f.dataType == T.DoubleType() else F.col(f.name)
            for f in schema
        ]
    )
