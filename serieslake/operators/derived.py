"""Derived series: spreads, flies, boxes, ratios and log volatility over parent series."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.functions.numeric import safe_ratio
from serieslake.functions.text import parent_codes
from serieslake.operators.joins import small_side
from serieslake.operators.rolling import log_return_volatility
from serieslake.operators.values import order_key, save_order
from serieslake.schema import (
    CALC_TYPE,
    PARENT_SERIES_CODE,
    SERIES_CODE,
    TIMESTAMP,
    VALUE,
    InvalidParentSeriesCountError,
    UnknownCalcTypeError,
)

RowFormula = Callable[[Sequence[Column]], Column]
SeriesFormula = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Calculator:
    """How many parents a type takes, and either a formula over the parents of one timestamp
    or a function of the whole (series_code, timestamp, value) frame of first parents."""

    parents: int
    row: RowFormula | None = None
    series: SeriesFormula | None = None


CALCULATORS: dict[str, Calculator] = {
    "SPREAD": Calculator(2, row=lambda p: p[0] - p[1]),
    "FLY": Calculator(3, row=lambda p: p[0] - 2.0 * p[1] + p[2]),
    "BOX": Calculator(4, row=lambda p: p[0] - p[1] - p[2] + p[3]),
    "RATIO": Calculator(2, row=lambda p: safe_ratio(p[0], p[1])),
    "SPREAD_INV": Calculator(2, row=lambda p: p[1] - p[0]),
    "RATIO_INV": Calculator(2, row=lambda p: safe_ratio(p[1], p[0])),
    "LOG": Calculator(1, series=log_return_volatility),
}


def register_calculator(name: str, calculator: Calculator) -> None:
    """Add a derived-series type."""
    if (calculator.row is None) == (calculator.series is None):
        raise ValueError("a calculator needs exactly one of row and series")
    CALCULATORS[name.strip().upper()] = calculator


def dependency_edges(dependencies: DataFrame) -> DataFrame:
    """One row per (derived series, parent position)."""
    typed = dependencies.select(
        F.trim(SERIES_CODE).alias("derived_code"),
        F.upper(F.trim(CALC_TYPE)).alias(CALC_TYPE),
        parent_codes(F.col(PARENT_SERIES_CODE)).alias("parents"),
    ).filter("derived_code IS NOT NULL AND calc_type IS NOT NULL AND size(parents) > 0")
    return typed.distinct().select(
        "derived_code",
        CALC_TYPE,
        F.size("parents").alias("parent_count"),
        F.posexplode("parents").alias("position", SERIES_CODE),
    )


def parent_list(dependencies: DataFrame) -> DataFrame:
    """Distinct parent series of all dependencies."""
    return dependency_edges(dependencies).select(SERIES_CODE).distinct()


def used_types(dependencies: DataFrame) -> list[str]:
    """Types in use, after checking that each is known and has the right number of parents.

    A small job over the dependency table; only (type, parent count) pairs come back.
    """
    edges = dependency_edges(dependencies)
    used = edges.select(CALC_TYPE, "parent_count").distinct().collect()
    for name, count in used:
        if name not in CALCULATORS:
            raise UnknownCalcTypeError(f"unknown calc_type {name!r}")
        if count != CALCULATORS[name].parents:
            raise InvalidParentSeriesCountError(
                f"calc_type {name} takes {CALCULATORS[name].parents} parent series, got {count}"
            )
    return sorted({row[0] for row in used})


def align_parents(values: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Parents side by side per (derived series, timestamp); incomplete timestamps are dropped.

    The dependency edges are the small side of an equi-join, and the aggregate that lines the
    parents up also settles repeated saves, so there is one shuffle, on (derived, timestamp):
    a parent used by many series or one very long series spreads over all tasks.
    """
    edges = dependency_edges(dependencies)
    widest = max(calculator.parents for calculator in CALCULATORS.values())
    order = order_key(*(save_order(values) or [VALUE]))
    present = values.filter(F.col(VALUE).isNotNull())
    slots = [
        F.max_by(VALUE, F.when(F.col("position") == i, order)).alias(f"p{i}")
        for i in range(widest)
    ]
    aligned = (
        present.join(small_side(edges), SERIES_CODE)
        .groupBy("derived_code", CALC_TYPE, "parent_count", TIMESTAMP)
        .agg(*slots)
    )
    known = sum((F.col(f"p{i}").isNotNull().cast("int") for i in range(widest)), F.lit(0))
    return aligned.filter(known == F.col("parent_count"))


def derive_series(values: DataFrame, dependencies: DataFrame) -> DataFrame:
    """All derived series of a dependency table in one job: (series_code, timestamp, value)."""
    types = used_types(dependencies)
    aligned = align_parents(values, dependencies)
    widest = max(calculator.parents for calculator in CALCULATORS.values())
    slots = [F.col(f"p{i}") for i in range(widest)]
    per_row = [name for name in types if CALCULATORS[name].row is not None]
    formula = F.lit(None).cast("double")
    for name in per_row:
        formula = F.when(F.col(CALC_TYPE) == name, CALCULATORS[name].row(slots)).otherwise(formula)
    result = aligned.filter(F.col(CALC_TYPE).isin(per_row)).select(
        F.col("derived_code").alias(SERIES_CODE), TIMESTAMP, formula.alias(VALUE)
    )
    for name in types:
        if CALCULATORS[name].series is None:
            continue
        first_parent = aligned.filter(F.col(CALC_TYPE) == name).select(
            F.col("derived_code").alias(SERIES_CODE), TIMESTAMP, F.col("p0").alias(VALUE)
        )
        result = result.unionByName(CALCULATORS[name].series(first_parent))
    return result


def split_derived(codes: DataFrame, dependencies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(derived, primary): requested codes that have a formula, and those that do not."""
    known = dependencies.select(F.trim(SERIES_CODE).alias(SERIES_CODE)).distinct()
    derived = codes.join(known, SERIES_CODE, "left_semi")
    primary = codes.join(known, SERIES_CODE, "left_anti")
    return derived, primary


def live_merge(primary: DataFrame, derived: DataFrame) -> DataFrame:
    """Primary and derived long rows in one frame."""
    columns = [SERIES_CODE, TIMESTAMP, VALUE]
    return primary.select(*columns).unionByName(derived.select(*columns))
