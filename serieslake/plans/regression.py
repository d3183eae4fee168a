"""Least squares and unit-root numbers for one window of a few hundred rows.

Small numpy helpers called per row inside Spark tasks; Spark decides which windows exist and
where they run (see :mod:`serieslake.plans.estimation`).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

# Response-surface coefficients for the unit-root test with a constant and one
# variable. P-value polynomials from MacKinnon (1994), critical values from MacKinnon (2010).
TAU_MIN, TAU_SPLIT, TAU_MAX = -18.83, -1.61, 2.74
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


@dataclass(frozen=True)
class Fit:
    """Coefficients (constant first), residuals and the numbers derived from them."""

    beta: np.ndarray
    fitted: np.ndarray
    residuals: np.ndarray
    scale_matrix: np.ndarray
    rank: int

    @property
    def n(self) -> int:
        return len(self.residuals)

    @property
    def sse(self) -> float:
        return float(self.residuals @ self.residuals)

    def standard_errors(self) -> np.ndarray:
        free = self.n - self.rank
        if free <= 0:
            return np.full(len(self.beta), np.nan)
        return np.sqrt(self.sse / free * np.diag(self.scale_matrix))

    def p_values(self) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            ratios = self.beta / self.standard_errors()
        return np.array([student_two_sided(t, self.n - self.rank) for t in ratios])


def least_squares(y: np.ndarray, columns: np.ndarray, *, constant: bool = True) -> Fit:
    """Pseudo-inverse least squares, so a repeated column shares its weight evenly."""
    design = np.column_stack([np.ones(len(y)), columns]) if constant else columns
    inverse = np.linalg.pinv(design, rcond=1e-15)
    beta = inverse @ y
    fitted = design @ beta
    return Fit(
        beta, fitted, y - fitted, inverse @ inverse.T, int(np.linalg.matrix_rank(design))
    )


def student_two_sided(t: float, df: int) -> float:
    """Two-sided p-value of a t ratio with whole degrees of freedom, by its finite series."""
    if math.isnan(t) or df <= 0:
        return math.nan
    angle, square, odd = math.atan(abs(t) / math.sqrt(df)), df / (df + t * t), df % 2
    term, total = 1.0, 0.0
    for k in range(1, (df - odd) // 2 + 1):
        total += term
        term *= square * ((2 * k) / (2 * k + 1) if odd else (2 * k - 1) / (2 * k))
    if odd:
        inside = 2 / math.pi * (angle + math.sin(angle) * math.cos(angle) * total)
    else:
        inside = math.sin(angle) * total
    return max(1.0 - inside, 0.0)


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def unit_root_p_value(statistic: float) -> float:
    if math.isnan(statistic):
        return math.nan
    if statistic > TAU_MAX:
        return 1.0
    if statistic < TAU_MIN:
        return 0.0
    terms = SMALL_P if statistic <= TAU_SPLIT else LARGE_P
    return normal_cdf(sum(c * statistic**i for i, c in enumerate(terms)))


def critical_value(level: str, n: int) -> float:
    return sum(c / n**i for i, c in enumerate(CRITICAL[level]))


@dataclass(frozen=True)
class UnitRoot:
    statistic: float
    p_value: float
    lags: int
    n: int


def _lag_design(changes: np.ndarray, levels: np.ndarray, lags: int) -> np.ndarray:
    """Columns: last level, then 1..lags earlier changes, for every row with all of them."""
    rows = len(changes) - lags
    columns = [levels[lags : lags + rows]]
    columns += [changes[lags - i : lags - i + rows] for i in range(1, lags + 1)]
    return np.column_stack(columns)


def unit_root_test(series: np.ndarray) -> UnitRoot:
    """Augmented Dickey-Fuller test with a constant; lag count by the Bayesian criterion.

    Candidate lag counts are compared on the sample the longest one allows; the chosen one is
    then refitted on all rows it can use.
    """
    series = np.asarray(series, dtype=float)
    total = len(series)
    longest = min(math.ceil(12.0 * (total / 100.0) ** 0.25), total // 2 - 2)
    if longest < 0 or np.ptp(series) == 0.0:
        return UnitRoot(math.nan, math.nan, 0, total)
    changes, levels = np.diff(series), series[:-1]
    target = changes[longest:]
    n = len(target)
    # Candidate designs are nested, so one orthogonal basis gives every sum of squared errors.
    design = np.column_stack([np.ones(n), _lag_design(changes, levels, longest)])
    basis, _ = np.linalg.qr(design)
    explained = np.cumsum((basis.T @ target) ** 2)
    errors = np.maximum(float(target @ target) - explained[1:], 0.0)
    with np.errstate(divide="ignore"):
        criteria = n * np.log(errors / n) + math.log(n) * np.arange(2, longest + 3)
    lags = int(np.argmin(criteria))
    fit = least_squares(changes[lags:], _lag_design(changes, levels, lags))
    with np.errstate(divide="ignore", invalid="ignore"):
        statistic = float(fit.beta[1] / fit.standard_errors()[1])
    return UnitRoot(statistic, unit_root_p_value(statistic), lags, len(changes) - lags)
