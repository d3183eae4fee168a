"""Data-quality rules as boolean columns, evaluated in one pass; gates for writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.functions.dates import age_days, parse_timestamp
from serieslake.functions.numeric import is_finite
from serieslake.functions.text import blank_to_null
from serieslake.schema import (
    CALC_TYPE,
    PARENT_SERIES_CODE,
    SERIES_CODE,
    SERIES_NAME,
    TIMESTAMP,
    VALUE,
    FrameValidationError,
)

SHOWN_PER_CATEGORY = 10
FRESHNESS_DAYS = 3


@dataclass(frozen=True)
class Rule:
    """A named condition that marks a row as failing."""

    check: str
    category: str
    fails: Column


def _blank(column: str) -> Column:
    return F.col(column).isNotNull() & blank_to_null(F.col(column).cast("string")).isNull()


def _unpaired(left: str, right: str) -> Column:
    return F.col(left).isNull() != F.col(right).isNull()


def metadata_rules(columns: Sequence[str]) -> list[Rule]:
    """Row rules of the series catalog; rules about absent optional columns are left out."""
    rules = []
    for column in (SERIES_CODE, SERIES_NAME):
        rules.append(Rule(f"{column} must be set", "null", F.col(column).isNull()))
        rules.append(Rule(f"{column} must not be blank", "null", _blank(column)))
    for left, right in (("bbg_ticker", "bbg_field"), (CALC_TYPE, PARENT_SERIES_CODE)):
        if left in columns and right in columns:
            rules.append(
                Rule(f"{left}/{right} must both be set", "pairing", _unpaired(left, right))
            )
    if "valid_from" in columns and "valid_to" in columns:
        starts = parse_timestamp(F.col("valid_from"))
        ends = parse_timestamp(F.col("valid_to"))
        fails = F.coalesce(starts > ends, F.lit(False))
        rules.append(Rule("valid_from must be <= valid_to", "other", fails))
    return rules


def rule_failures(frame: DataFrame, rules: Sequence[Rule], *keep: str) -> DataFrame:
    """One row per (row, failed rule); all rules are checked in one scan."""
    entries = F.array(
        *[
            F.when(
                rule.fails,
                F.struct(F.lit(rule.category).alias("category"), F.lit(rule.check).alias("check")),
            )
            for rule in rules
        ]
    )
    return (
        frame.select(*keep, F.explode(entries).alias("failure"))
        .filter("failure IS NOT NULL")
        .select(*keep, "failure.category", "failure.check")
    )


def metadata_failures(frame: DataFrame, extra_rules: Sequence[Rule] = ()) -> DataFrame:
    """(series_code, category, check, n): every failure of the catalog rules.

    Repeats are found with an aggregate per code, never with a window over a code's rows.
    """
    missing = [c for c in (SERIES_CODE, SERIES_NAME) if c not in frame.columns]
    if missing:
        raise FrameValidationError(f"missing required column(s): {missing}")
    rules = [*metadata_rules(frame.columns), *extra_rules]
    by_row = (
        rule_failures(frame, rules, SERIES_CODE)
        .groupBy(SERIES_CODE, "category", "check")
        .agg(F.count("*").alias("n"))
    )
    repeated = (
        frame.groupBy(SERIES_CODE)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
        .select(
            SERIES_CODE,
            F.lit("duplicate").alias("category"),
            F.lit("series_code must be unique").alias("check"),
            "n",
        )
    )
    return by_row.unionByName(repeated)


def failure_counts(failures: DataFrame) -> DataFrame:
    """Failures per category."""
    return failures.groupBy("category").agg(F.sum("n").alias("failures"))


def failure_examples(failures: DataFrame, shown: int = SHOWN_PER_CATEGORY) -> DataFrame:
    """A few failures of each category: one small top-k per category, no window."""
    parts = [
        failures.filter(F.col("category") == category)
        .orderBy(F.col(SERIES_CODE).asc_nulls_last(), "check")
        .limit(shown)
        for category in ("duplicate", "null", "pairing", "other")
    ]
    return reduce(lambda left, right: left.unionByName(right), parts)


def value_failures(frame: DataFrame, now: Column | None = None) -> DataFrame:
    """(series_code, check, n) for series without data, infinite values, repeated or future
    timestamps."""
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    infinite = F.col(VALUE).isNotNull() & ~is_finite(F.col(VALUE))
    per_time = frame.groupBy(SERIES_CODE, TIMESTAMP).agg(
        F.count("*").alias("n"),
        F.count(VALUE).alias("known"),
        F.count_if(infinite).alias("infinite"),
    )
    per_series = per_time.groupBy(SERIES_CODE).agg(
        F.sum("known").alias("known"),
        F.sum("infinite").alias("infinite"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        F.count_if(F.col(TIMESTAMP) > now).alias("future"),
    )
    checks = F.array(
        *[
            F.struct(F.lit(check).alias("check"), count.cast("bigint").alias("n"))
            for check, count in (
                ("series has no data", (F.col("known") == 0).cast("int")),
                ("value is not finite", F.col("infinite")),
                ("timestamp is repeated", F.col("repeated")),
                ("timestamp is in the future", F.col("future")),
            )
        ]
    )
    return (
        per_series.select(SERIES_CODE, F.explode(checks).alias("c"))
        .select(SERIES_CODE, "c.check", "c.n")
        .filter("n > 0")
    )


def require_columns(frame: DataFrame, columns: Sequence[str]) -> None:
    """Driver-side check of the schema; no job."""
    missing = [column for column in columns if column not in frame.columns]
    if missing:
        raise FrameValidationError(f"missing required column(s): {missing}")


def require_known(frame: DataFrame, columns: Sequence[str]) -> None:
    """Required columns exist and hold no NULL; all violations are reported together."""
    require_columns(frame, columns)
    counts = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    bad = {column: counts[column] for column in columns if counts[column]}
    if bad:
        raise FrameValidationError(f"NULL in required column(s): {bad}")


def gate(frame: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """Failing rows per rule in one aggregate; an empty result means the write may go ahead."""
    if not rules:
        return {}
    row = frame.agg(
        *[F.count_if(rule.fails).alias(f"r{i}") for i, rule in enumerate(rules)]
    ).first()
    return {rule.check: row[f"r{i}"] for i, rule in enumerate(rules) if row[f"r{i}"]}


def failing_keys(frame: DataFrame, keys: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """Keys with at least one failing row and the names of the rules broken."""
    broken = F.array(
        *[F.when(F.count_if(rule.fails) > 0, F.lit(rule.check)) for rule in rules]
    )
    return (
        frame.groupBy(*keys)
        .agg(F.array_compact(broken).alias("failed_checks"))
        .filter(F.size("failed_checks") > 0)
    )


def drop_failing(frame: DataFrame, keys: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """Rows of the keys that break no rule."""
    return frame.join(failing_keys(frame, keys, rules).select(*keys), list(keys), "left_anti")


def out_of_range(column: str, low: float, high: float, *, nullable: bool = True) -> Column:
    """Fails outside [low, high] (NaN included), and on NULL unless allowed."""
    value = F.col(column)
    outside = F.isnan(value) | (value < low) | (value > high)
    return F.coalesce(outside, F.lit(not nullable))


def freshness(
    frame: DataFrame,
    as_of: Column,
    *,
    keys: Sequence[str] = (SERIES_CODE,),
    tolerance_days: int = FRESHNESS_DAYS,
    day: str = TIMESTAMP,
) -> DataFrame:
    """Age of each key's newest row and whether it is within tolerance."""
    latest = frame.groupBy(*keys).agg(F.max(day).alias("latest"))
    age = age_days(as_of, F.col("latest"))
    return latest.select(
        *keys,
        "latest",
        age.alias("age_days"),
        F.coalesce(age <= tolerance_days, F.lit(False)).alias("is_fresh"),
    )


def disallowed_values(
    frame: DataFrame, allowed: Mapping[str, Sequence[str]] | DataFrame, fields: Sequence[str]
) -> DataFrame:
    """(field, value, n) of catalog values outside the allowed (field, value) table."""
    pairs = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]
    )
    counts = (
        frame.select(F.explode(pairs).alias("p"))
        .select("p.field", "p.value")
        .filter("value IS NOT NULL")
        .groupBy("field", "value")
        .agg(F.count("*").alias("n"))
    )
    if isinstance(allowed, DataFrame):
        return counts.join(allowed.select("field", "value"), ["field", "value"], "left_anti")
    known = reduce(
        lambda left, right: left | right,
        [
            (F.col("field") == field) & F.col("value").isin(list(values))
            for field, values in allowed.items()
        ],
        F.lit(False),
    )
    return counts.filter(~known)


def duplicate_tickers(frame: DataFrame, ticker: str, field: str) -> DataFrame:
    """Vendor references used by more than one series."""
    return (
        frame.filter(F.col(ticker).isNotNull())
        .groupBy(ticker, field)
        .agg(F.count_distinct(SERIES_CODE).alias("series"))
        .filter("series > 1")
    )
