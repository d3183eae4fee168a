"""String expressions: currency legs, parent lists, tenors, vendor aliases, labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from serieslake.schema import SOURCE_ALIASES

USD = "USD"

# Months per tenor unit.
TENOR_UNIT_MONTHS = {"D": 1 / 30, "W": 1 / 4.345, "M": 1.0, "Y": 12.0}


def _leg(code: Column, position: int) -> Column:
    return F.nullif(F.regexp_extract(code, r"^([A-Z]{3})([A-Z]{3})_", position), F.lit(""))


def base_currency(code: Column) -> Column:
    """First leg of a code such as ``EURUSD_PX_LAST``; NULL when the code is not a pair."""
    return _leg(code, 1)


def quote_currency(code: Column) -> Column:
    """Second leg of a currency-pair code; NULL when the code is not a pair."""
    return _leg(code, 2)


def non_usd_leg(base: Column, quote: Column) -> Column:
    """``'base'`` or ``'quote'``, whichever leg is not USD; NULL when neither or both are."""
    return F.when((base == USD) & (quote != USD), F.lit("quote")).when(
        (quote == USD) & (base != USD), F.lit("base")
    )


def non_usd_currency(base: Column, quote: Column) -> Column:
    """The currency of the non-USD leg; NULL when neither or both legs are USD."""
    return F.when((base == USD) & (quote != USD), quote).when(
        (quote == USD) & (base != USD), base
    )


def parent_codes(parents: Column) -> Column:
    """Array of parent codes from a pipe-delimited list, blanks removed; empty for NULL."""
    parts = F.transform(F.split(parents, r"\|"), lambda part: F.trim(part))
    return F.coalesce(
        F.filter(parts, lambda part: part != ""), F.array().cast("array<string>")
    )


def tenor_months(tenor: Column) -> Column:
    """Tenor length in months for sorting; text that is no tenor sorts last (infinity)."""
    text = F.trim(tenor)
    pattern = r"^(?i)(\d+(?:\.\d+)?)\s*([DWMY])"
    amount = F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("double")
    unit = F.upper(F.regexp_extract(text, pattern, 2))
    months = reduce(
        lambda acc, item: acc.when(unit == item[0], F.lit(item[1])),
        list(TENOR_UNIT_MONTHS.items())[1:],
        F.when(unit == "D", F.lit(TENOR_UNIT_MONTHS["D"])),
    )
    return F.coalesce(amount * months, F.lit(float("inf")))


def canonical_source(source: Column) -> Column:
    """Vendor alias to canonical name, unknown names lower-cased."""
    aliases = F.create_map(*[F.lit(x) for pair in SOURCE_ALIASES.items() for x in pair])
    trimmed = F.trim(source)
    return F.coalesce(F.try_element_at(aliases, F.upper(trimmed)), F.lower(trimmed))


def blank_to_null(text: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.nullif(trimmed, F.lit(""))


def is_false_text(flag: Column) -> Column:
    """True where an all-text catalog spells a boolean false."""
    return F.lower(F.trim(flag.cast("string"))).isin("false", "0", "f", "no")


def joined_names(names: Column) -> Column:
    """Comma-joined names, the stored form of a list of drivers."""
    return F.array_join(names, ",")


def split_names(text: Column) -> Column:
    """Inverse of :func:`joined_names`; an empty string is an empty list."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda name: name != "")


def day_label(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd")


def range_label(low: Column, high: Column) -> Column:
    return F.format_string("%.2f to %.2f", low, high)
