from __future__ import annotations

import pytest
from conftest import records
from pyspark.sql import functions as F

from serieslake.functions import text
from serieslake.operators import catalog as cat
from serieslake.schema import (
    InvalidFilterFieldError,
    InvalidFilterValueError,
    UnsupportedTickerSourceError,
    normalize_source,
    vendor_columns,
)


@pytest.fixture
def catalog(spark):
    return spark.createDataFrame(
        [
            ("A", "Equity", "USD"),
            ("B", "Equity", None),
            ("C", "Currency", "EUR"),
            (" ", None, "EUR"),
            (None, "Equity", " USD "),
        ],
        "series_code string, asset_class string, currency string",
    )


def codes(frame):
    return records(frame, "series_code")


def test_include_and_both_kinds_of_exclude(catalog):
    assert codes(cat.include(catalog, {"asset_class": ["Equity"], "currency": ["USD"]})) == [("A",)]
    assert codes(cat.exclude(catalog, {"currency": ["USD"]})) == [(" ",), ("C",), (None,)]
    assert ("B",) in codes(cat.narrow_exclude(catalog, {"currency": ["USD"]}))
    assert ("B",) not in codes(cat.exclude(catalog, {"currency": ["USD"]}))


def test_empty_lists(catalog):
    assert cat.include(catalog, {"currency": []}).count() == 0
    assert cat.narrow_exclude(catalog, {"currency": []}).count() == 5
    assert cat.merge_filters({"a": "x", "b": []}, {"a": ["y", "y", "z"]}) == {"a": ["y", "z"]}


def test_unknown_field_and_strict_values(catalog):
    with pytest.raises(InvalidFilterFieldError, match="asset_class"):
        cat.include(catalog, {"colour": ["red"]})
    cat.check_values(catalog, {"currency": ["EUR"]})
    with pytest.raises(InvalidFilterValueError, match="GBP"):
        cat.check_values(catalog, {"currency": ["EUR", "GBP"]})


def test_series_codes_are_trimmed_and_not_blank(catalog):
    assert codes(cat.series_codes(catalog)) == [("A",), ("B",), ("C",)]


def test_options_of_all_fields_in_one_shuffle(catalog):
    options = cat.filter_options(catalog)
    plan = options._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert ("currency", "USD") in records(options)
    assert records(options).count(("asset_class", "Equity")) == 1


def test_groups_keep_missing_keys(catalog):
    groups = cat.group_series(catalog, ["currency"])
    assert records(groups, "currency", "series_code") == [("EUR", "C"), ("USD", "A"), (None, "B")]


def test_union_first_wins_even_for_missing_codes(spark, catalog):
    other = spark.createDataFrame(
        [("A", "changed", 1), ("D", "new", 2), (None, "x", 3)],
        "series_code string, asset_class string, extra int",
    )
    merged = cat.union_first_wins(catalog, other)
    assert records(merged.filter("series_code = 'A'"), "asset_class", "extra") == [("Equity", None)]
    assert merged.filter("series_code IS NULL").count() == 1
    assert records(merged.filter("series_code = 'D'"), "currency", "extra") == [(None, 2)]


def test_sources():
    assert [normalize_source(s) for s in ("BBG", " Bloomberg ", "hawkeye", "OneTick", "Ramp")] == [
        "bloomberg", "bloomberg", "hawk", "mds", "ramp",
    ]
    assert vendor_columns("bloomberg") == ("bbg_ticker", "bbg_field")
    with pytest.raises(UnsupportedTickerSourceError):
        vendor_columns("ramp")


def test_text_expressions(spark):
    rows = spark.createDataFrame(
        [("EURUSD_PX_LAST", "A | B||C", "2Y"), ("USDJPY_X", None, "1w"), ("EURGBP_X", "", "x"), ("bad", " ", "18.5 M")],
        "code string, parents string, tenor string",
    )
    base, quote = text.base_currency(F.col("code")), text.quote_currency(F.col("code"))
    shown = rows.select(
        base, quote, text.non_usd_leg(base, quote), text.non_usd_currency(base, quote),
        text.parent_codes(F.col("parents")), text.tenor_months(F.col("tenor")),
    ).collect()
    assert tuple(shown[0]) == ("EUR", "USD", "base", "EUR", ["A", "B", "C"], 24.0)
    assert tuple(shown[1])[:5] == ("USD", "JPY", "quote", "JPY", [])
    assert abs(shown[1][5] - 1 / 4.345) < 1e-12
    assert tuple(shown[2])[2:] == (None, None, [], float("inf"))
    assert shown[3][0] is None and shown[3][5] == 18.5
