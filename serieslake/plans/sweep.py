"""Regressions from sums of products by the sweep operator, in expressions.

A sweep on one place of the moment matrix exchanges it between "explained" and "explaining". After
sweeping the constant and the drivers, the matrix holds the inverse, the coefficients and the sum of
squared errors. A fit is a fold of sweeps over an array of places, so the sign check and the refit on
fewer drivers are two folds over the same kind of matrix.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.plans.drivers import RATE, by_universe
from serieslake.plans.universes import Universe
from serieslake.plans.windows import KEYS, sum_places

#: A driver whose variance beyond the others is below this share repeats them.
REPEATED = 1e-10
#: Added share of the variance where drivers repeat each other: they then share their weight.
RIDGE = 1e-9
#: A driver whose variance is below this share of its mean square does not move.
STILL = 1e-13


def sweep(matrix: Column, place: Column) -> Column:
    """The matrix (rows of an array) swept on one place, from 0."""
    pivot_row = F.get(matrix, place)
    pivot = F.get(pivot_row, place)

    def swept(row: Column, i: Column) -> Column:
        own = F.transform(row, lambda x, j: F.try_divide(F.when(j == place, F.lit(1.0)).otherwise(x), pivot))
        share = F.try_divide(F.get(row, place), pivot)
        other = F.zip_with(row, pivot_row, lambda x, p: x - share * p)
        other = F.transform(other, lambda x, j: F.when(j == place, -share).otherwise(x))
        return F.when(i == place, own).otherwise(other)

    return F.transform(matrix, swept)


def swept_over(matrix: Column, places: Column, spread: Column) -> Column:
    """Sweeps one place after another. Returns the matrix and ``low``, the smallest pivot as a share
    of ``spread`` (the variance of each place about the mean)."""
    start = F.struct(matrix.alias("m"), F.lit(1.0).alias("low"))

    def step(state: Column, place: Column) -> Column:
        pivot = F.get(F.get(state["m"], place), place)
        share = F.when(place > 0, F.try_divide(pivot, F.get(spread, place))).otherwise(F.lit(1.0))
        return F.struct(sweep(state["m"], place).alias("m"), F.least(state["low"], share).alias("low"))

    return F.aggregate(places, start, step)


def student_tail(ratio: Column, free: Column) -> Column:
    """Two-sided p-value of a t ratio with whole degrees of freedom, by its finite series."""
    angle = F.atan(F.abs(ratio) / F.sqrt(free))
    square = free / (free + ratio * ratio)
    odd = free % 2 == 1
    terms = F.floor((free - F.when(odd, 1).otherwise(0)) / 2).cast("int")
    zero = F.struct(F.lit(0.0).alias("total"), F.lit(1.0).alias("term"))

    def add(state: Column, k: Column) -> Column:
        up = F.when(odd, 2 * k / (2 * k + 1)).otherwise((2 * k - 1) / (2 * k))
        return F.struct(
            (state["total"] + state["term"]).alias("total"), (state["term"] * up * square).alias("term")
        )

    summed = F.when(terms > 0, F.aggregate(F.sequence(F.lit(1), terms), zero, add)["total"]).otherwise(F.lit(0.0))
    inside = F.when(odd, 2 / math.pi * (angle + F.sin(angle) * F.cos(angle) * summed)).otherwise(
        F.sin(angle) * summed
    )
    return F.when((free > 0) & ratio.isNotNull() & ~F.isnan(ratio), F.greatest(1 - inside, F.lit(0.0)))


def _bits(places: Column) -> Column:
    """Cells that a row must have: the response and the drivers at ``places`` (from 1)."""
    response = F.when(F.col("is_logged"), F.lit(0b11)).otherwise(F.lit(0b01))
    return F.aggregate(places, response, lambda bits, j: bits + F.pow(F.lit(2.0), j + 1).cast("int"))


def _usable(classes: Column, need: Column) -> Column:
    return F.filter(classes, lambda c: c["mask"].bitwiseAND(need) == 0)


def _total(classes: Column, size: int) -> Column:
    zeros = F.array_repeat(F.lit(0.0), size)
    return F.aggregate(classes, zeros, lambda held, c: F.zip_with(held, c["sums"], lambda a, b: a + b))


def _matrix(total: Column, count: int) -> Column:
    """Moment matrix over the constant, ``count`` drivers and the response."""
    places = sum_places(count + 2)

    def of(response: int) -> Column:
        order = [-1, *range(2, count + 2), response]
        return F.array(
            *[F.array(*[total[places[min(a, b), max(a, b)]] for b in order]) for a in order]
        )

    return F.when(F.col("is_logged"), of(1)).otherwise(of(0))


def _solve(
    frame: DataFrame, name: str, places: Column, bits: Column, need: Column, count: int
) -> DataFrame:
    """Adds ``name``, null matrix below ``need`` rows: n, m (swept), used (the places that move), mean square and last row."""
    size = len(sum_places(count + 2))
    frame = frame.withColumn("_use", _usable(F.col("classes"), bits))
    frame = frame.withColumn("_total", _total(F.col("_use"), size))
    frame = frame.withColumn("_matrix", _matrix(F.col("_total"), count)).withColumn("_n", F.col("_total")[0])
    matrix, n = F.col("_matrix"), F.col("_n")
    diagonal = F.transform(matrix, lambda row, i: F.get(row, i))
    means = F.get(matrix, F.lit(0))
    frame = frame.withColumn("_square", diagonal).withColumn(
        "_spread", F.zip_with(diagonal, means, lambda s, m: s - F.try_divide(m * m, n))
    )
    moves = F.filter(
        places, lambda j: (j == 0) | (F.get("_spread", j) > STILL * F.get("_square", j))
    )
    frame = frame.withColumn("_places", moves)
    frame = frame.withColumn("_plain", F.when(n >= need, swept_over(matrix, F.col("_places"), F.col("_spread"))))
    lifted = F.transform(
        matrix,
        lambda row, i: F.transform(
            row, lambda x, j: F.when((i == j) & (i > 0) & (i <= count), x + RIDGE * F.get("_spread", i)).otherwise(x)
        ),
    )
    repeated = F.col("_plain.low") < REPEATED
    swept = F.when(repeated, swept_over(lifted, F.col("_places"), F.col("_spread"))["m"]).otherwise(F.col("_plain.m"))
    last = F.array_max(F.transform(F.col("_use"), lambda c: c["last"]))
    frame = frame.withColumn("_swept", swept)
    swept = F.col("_swept")
    errors = F.get(F.get(swept, F.lit(count + 1)), F.lit(count + 1))
    solved = F.struct(
        F.round(n).cast("long").alias("n"),
        swept.alias("m"),
        F.col("_places").alias("used"),
        F.when(repeated, F.size("_places") - 1).otherwise(F.size("_places")).alias("rank"),
        F.greatest(errors, F.lit(0.0)).alias("errors"),
        F.get("_spread", F.lit(count + 1)).alias("spread"),
        last.alias("last"),
    )
    return frame.withColumn(name, solved).drop(
        "_use", "_total", "_matrix", "_n", "_square", "_spread", "_places", "_plain", "_swept"
    )


def solve_fits(sums: DataFrame, universes: Mapping[str, Universe], drivers: Sequence[str]) -> DataFrame:
    """Fit, sign check and one refit for every row of :func:`windows.window_sums` over ``drivers``.

    Adds ``first`` and ``final`` (see :func:`_solve`), ``places`` (of the universe's drivers, from 1),
    ``kept`` (those that pass the sign check) and ``status``. A driver that does not move in the window
    gets the coefficient zero; drivers that repeat each other share their weight.
    """
    count = len(drivers)
    need = by_universe("min_observations", universes)

    def listed(of) -> Column:
        chosen = F.expr("CAST(array() AS array<int>)")
        for name, universe in universes.items():
            values = F.array(*[F.lit(value) for value in of(universe)])
            chosen = F.when(F.col("universe") == name, values).otherwise(chosen)
        return chosen

    frame = (
        sums.withColumn("places", listed(lambda u: [j + 1 for j, name in enumerate(drivers) if name in u.drivers]))
        .withColumn("_signs", listed(lambda u: [u.expected_signs.get(name, 0) for name in drivers]))
        .withColumn("is_logged", F.col("newest.is_logged"))
        .withColumn("current_rate", F.when(~F.isnan(f"newest.{RATE}"), F.col(f"newest.{RATE}")))
    )
    every, nothing = F.col("places"), F.expr("CAST(array() AS array<int>)")
    frame = _solve(frame, "first", F.concat(F.array(F.lit(0)), every), _bits(every), need, count)
    slope = lambda j: coefficient(F.col("first"), j, count)
    right = F.filter(every, lambda j: ~(slope(j) * F.get("_signs", j - 1) < 0))
    frame = frame.withColumn("kept", F.when(F.col("first.n") >= need, right).otherwise(nothing))
    frame = _solve(
        frame, "_refit", F.concat(F.array(F.lit(0)), F.col("kept")), _bits(F.col("kept")), need, count
    )
    final = F.when(F.size("kept") == F.size(every), F.col("first")).otherwise(F.col("_refit"))
    frame = frame.withColumn("final", final).drop("_refit", "_signs")
    enough = (F.col("first.n") >= need) & (F.size("kept") > 0) & (F.col("final.n") >= need)
    return frame.withColumn("status", F.when(enough, "ok").otherwise("insufficient_data"))


def coefficient(fit: Column, place: Column, count: int) -> Column:
    """The slope at a place (from 1), zero where the driver does not move."""
    value = F.get(F.get(fit["m"], place), F.lit(count + 1))
    return F.when(F.array_contains(fit["used"], place), value).otherwise(F.lit(0.0))


def estimate_columns(solved: DataFrame, drivers: Sequence[str], *kept: str) -> DataFrame:
    """Numbers of the final fit as columns, the keys and what the unit-root test needs of the first
    one: ``first_n``, ``first_beta`` (constant and slopes in centred cells) and ``places``. Columns named in
    ``kept`` pass through."""
    count = len(drivers)
    ok, fit = F.col("status") == "ok", F.col("final")
    response = F.when(F.col("is_logged"), F.lit(1)).otherwise(F.lit(0))
    of_first = F.array(
        F.get(F.get("first.m", F.lit(0)), F.lit(count + 1)),
        *[coefficient(F.col("first"), F.lit(j + 1), count) for j in range(count)],
    )
    frame = solved.withColumn("first_beta", of_first).withColumn(
        "_slopes",
        F.array(
            *[
                F.when(F.array_contains("kept", F.lit(j + 1)), coefficient(fit, F.lit(j + 1), count)).otherwise(0.0)
                for j in range(count)
            ]
        ),
    )
    means = F.slice("centre", 3, count)
    dot = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda held, x: held + x
    )
    moved_const = F.get(F.get(fit["m"], F.lit(0)), F.lit(count + 1))
    cells = fit["last"]["cells"]
    frame = (
        frame.withColumn("_response", F.get("centre", response))
        .withColumn("_const", moved_const)
        .withColumn("_fitted", moved_const + dot(F.col("_slopes"), F.transform(F.slice(cells, 3, count), lambda x: F.coalesce(x, F.lit(0.0)))))
        .withColumn("_actual", F.get(cells, response))
        .withColumn("_std", F.sqrt(F.try_divide(fit["errors"], fit["n"])))
        .withColumn("_free", fit["n"] - fit["rank"])
        # The constant belongs to uncentred cells: its variance is that of the fit at the origin.
        .withColumn(
            "_origin",
            F.transform(
                F.sequence(F.lit(0), F.lit(count)),
                lambda j: F.when(j == 0, F.lit(1.0))
                .when(F.array_contains(fit["used"], j), -F.get(means, j - 1))
                .otherwise(F.lit(0.0)),
            ),
        )
    )
    inverse = F.slice(fit["m"], 1, count + 1)
    inner = F.zip_with(
        inverse, F.col("_origin"), lambda row, o: o * dot(F.slice(row, 1, count + 1), F.col("_origin"))
    )
    frame = frame.withColumn("_origin_variance", F.aggregate(inner, F.lit(0.0), lambda a, x: a + x)).withColumn(
        "_noise", F.when(F.col("_free") > 0, fit["errors"] / F.col("_free"))
    )
    betas = {"const": F.col("_response") + F.col("_const") - dot(F.col("_slopes"), means)}
    errors = {"const": F.sqrt(F.col("_noise") * F.col("_origin_variance"))}
    for j, name in enumerate(drivers):
        here = F.array_contains("kept", F.lit(j + 1))
        variance = F.get(F.get(fit["m"], F.lit(j + 1)), F.lit(j + 1))
        moves = F.array_contains(fit["used"], F.lit(j + 1))
        betas[name] = F.when(here, F.get("_slopes", F.lit(j)))
        errors[name] = F.when(here & moves, F.sqrt(F.col("_noise") * variance))
    frame = frame.withColumns({f"_b_{k}": v for k, v in betas.items()})
    frame = frame.withColumns({f"_e_{k}": v for k, v in errors.items()})
    tails = {
        k: student_tail(F.when(F.col(f"_e_{k}") > 0, F.col(f"_b_{k}") / F.col(f"_e_{k}")), F.col("_free"))
        for k in betas
    }
    shown = lambda value: F.when(ok, value)
    names = F.array(*[F.lit(name) for name in drivers])
    dropped = F.transform(F.array_except("places", "kept"), lambda j: F.get(names, j - 1))
    return frame.select(
        *KEYS,
        "status",
        "is_logged",
        "current_rate",
        shown(F.col("_response") + F.col("_fitted")).alias("fitted_value"),
        shown(F.col("_response") + F.col("_actual")).alias("actual_value"),
        shown(F.col("_std")).alias("residual_std"),
        shown(
            F.when(F.col("_std") > 0, (F.col("_actual") - F.col("_fitted")) / F.col("_std")).otherwise(0.0)
        ).alias("z_score"),
        shown(F.when(fit["spread"] > 0, 1 - fit["errors"] / fit["spread"])).alias("r_squared"),
        shown(fit["n"]).alias("n_obs"),
        shown(F.array_join(dropped, ",")).alias("dropped_variables"),
        *[shown(F.col(f"_b_{k}")).alias(f"coefficient_{k}") for k in betas],
        *[shown(F.col(f"_e_{k}")).alias(f"standard_error_{k}") for k in betas],
        *[shown(tails[k]).alias(f"p_value_{k}") for k in betas],
        F.col("first.n").alias("first_n"),
        "first_beta",
        "centre",
        "places",
        *kept,
    )
