"""Numeric expressions that treat unusable inputs as missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_double(value: Column) -> Column:
    """Number from any input; text that is no number, and NaN, become NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is zero."""
    return F.when(denominator != 0, numerator / denominator)


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != float("inf"))


def log_level(value: Column) -> Column:
    """Natural logarithm of a positive level, otherwise NULL."""
    return F.when(value > 0, F.ln(value))


def to_level(value: Column, is_logged: Column) -> Column:
    """Undo the logarithm where the regression was run on log levels."""
    return F.when(is_logged, F.exp(value)).otherwise(value)
