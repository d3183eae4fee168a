"""Which currency pairs a universe has, and which series feed their drivers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from serieslake.functions.text import (
    base_currency,
    is_false_text,
    non_usd_currency,
    non_usd_leg,
    quote_currency,
)
from serieslake.operators.catalog import include
from serieslake.plans.universes import (
    BOTH_LEG_ROLES,
    NON_USD_ROLES,
    ROLES,
    UNIVERSE_NAMES,
)
from serieslake.schema import SERIES_CODE

LEGS = ("base", "quote")
ROLE_COLUMNS = [f"{leg}_{role}" for leg in LEGS for role in ROLES]
REASON_SEPARATOR = "; "
# Fixed value: the reason text of a pair without exactly one USD leg.
NO_USD_LEG = (
    "EM and CHN pairs are USD-quoted by construction. EM driver 2 is the non-USD leg's 5Y "
    "sovereign CDS as a single-country level; a cross with two non-USD legs has no defined "
    "driver-2 treatment under the published spec."
)


def discover_pairs(
    catalog: DataFrame, universe: str | None = None, *, require_real: bool = False
) -> DataFrame:
    """(series_code, universe) of the currency pairs; ``require_real`` drops synthetic rows."""
    names = [universe] if universe else list(UNIVERSE_NAMES)
    pairs = include(
        catalog,
        {"asset_class": ["Currency"], "sub_asset_class": ["FX Spot"], "market_development": names},
    )
    if require_real and "is_synthetic" in catalog.columns:
        pairs = pairs.filter(is_false_text(F.col("is_synthetic")))
    return pairs.select(SERIES_CODE, F.col("market_development").alias("universe")).distinct()


def role_index(catalog: DataFrame) -> DataFrame:
    """(role, currency, role_code): the series that fills a role for a currency.

    Real series come before synthetic ones, then the lowest code wins. All roles are matched
    in one scan; the choice is a minimum, so a currency with very many candidates costs one
    row per task.
    """
    usable = {
        role: filters for role, filters in ROLES.items() if set(filters) <= set(catalog.columns)
    }
    matches = F.array(
        *[
            F.when(
                reduce(
                    lambda left, right: left & right,
                    [F.col(column) == value for column, value in filters.items()],
                ),
                F.lit(role),
            )
            for role, filters in usable.items()
        ]
    )
    if "is_synthetic" in catalog.columns:
        flag = F.when(F.col("is_synthetic").isNull(), 2).when(
            is_false_text(F.col("is_synthetic")), 0
        )
        synthetic = flag.otherwise(1)
    else:
        synthetic = F.lit(0)
    return (
        catalog.filter(F.col("currency").isNotNull())
        .select("currency", SERIES_CODE, synthetic.alias("_rank"), F.explode(matches).alias("role"))
        .filter("role IS NOT NULL")
        .groupBy("role", "currency")
        .agg(F.min(F.struct("_rank", SERIES_CODE))[SERIES_CODE].alias("role_code"))
    )


def _needs() -> Column:
    """Roles a pair must resolve, in reporting order: (place, leg, role, currency)."""
    base, quote = F.col("base_currency"), F.col("quote_currency")

    def need(place: int, leg: Column, role: str, currency: Column) -> Column:
        return F.struct(
            F.lit(place).alias("place"),
            leg.alias("leg"),
            F.lit(role).alias("role"),
            currency.alias("currency"),
        )

    result = None
    for universe in UNIVERSE_NAMES:
        entries = []
        for leg, currency in (("base", base), ("quote", quote)):
            for role in BOTH_LEG_ROLES[universe]:
                entries.append(need(len(entries), F.lit(leg), role, currency))
        for role in NON_USD_ROLES[universe]:
            entries.append(
                need(len(entries), non_usd_leg(base, quote), role, non_usd_currency(base, quote))
            )
        here = F.col("universe") == universe
        result = F.when(here, F.array(*entries)) if result is None else result.when(
            here, F.array(*entries)
        )
    return result


def _block_reason() -> Column:
    """Why a pair cannot be assessed at all; NULL when its roles can be looked up."""
    base, quote = F.col("base_currency"), F.col("quote_currency")
    needs_usd = [name for name in UNIVERSE_NAMES if NON_USD_ROLES[name]]
    return (
        F.when(
            base.isNull(),
            F.concat(
                F.lit("Could not parse currency legs from series_code '"),
                F.col(SERIES_CODE),
                F.lit("'."),
            ),
        )
        .when(
            ~F.col("universe").isin(*UNIVERSE_NAMES),
            F.concat(F.lit("Unknown universe '"), F.col("universe"), F.lit("'.")),
        )
        .when(
            F.col("universe").isin(needs_usd) & non_usd_leg(base, quote).isNull(),
            F.lit(NO_USD_LEG),
        )
    )


def resolve_roles(pairs: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per (pair, required role) with the series found, or the reason none was.

    The index is the small side of an equi-join without a hint, so its measured size decides
    between a broadcast and a shuffle; almost every pair asks for USD, and adaptive execution
    splits that key.
    """
    parsed = pairs.select(
        SERIES_CODE,
        "universe",
        base_currency(F.col(SERIES_CODE)).alias("base_currency"),
        quote_currency(F.col(SERIES_CODE)).alias("quote_currency"),
    ).withColumn("block_reason", _block_reason())
    needs = F.when(F.col("block_reason").isNull(), _needs())
    needed = parsed.select("*", F.explode_outer(needs).alias("n")).select(
        SERIES_CODE,
        "universe",
        "base_currency",
        "quote_currency",
        "block_reason",
        F.col("n.place").alias("place"),
        F.col("n.leg").alias("leg"),
        F.col("n.role").alias("role"),
        F.col("n.currency").alias("currency"),
    )
    found = needed.join(role_index(catalog), ["role", "currency"], "left")
    missing = F.when(
        F.col("role").isNotNull() & F.col("role_code").isNull(),
        F.concat(
            F.lit("No "), F.col("role"), F.lit(" series for "), F.col("currency"), F.lit(".")
        ),
    )
    return found.withColumn("reason", F.coalesce("block_reason", missing)).drop("block_reason")


def availability_report(pairs: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per pair: legs, whether it is blocked and why, and a column per (leg, role)."""
    roles = resolve_roles(pairs, catalog)
    cells = [
        F.max(
            F.when((F.col("leg") == leg) & (F.col("role") == role), F.col("role_code"))
        ).alias(f"{leg}_{role}")
        for leg in LEGS
        for role in ROLES
    ]
    reasons = F.sort_array(
        F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("place", "reason")))
    )
    return (
        roles.groupBy(SERIES_CODE, "universe", "base_currency", "quote_currency")
        .agg(
            (F.count("reason") > 0).alias("blocked"),
            F.array_join(F.transform(reasons, lambda r: r["reason"]), REASON_SEPARATOR).alias(
                "block_reasons"
            ),
            *cells,
        )
        .select(
            SERIES_CODE,
            "universe",
            "base_currency",
            "quote_currency",
            "blocked",
            "block_reasons",
            *ROLE_COLUMNS,
        )
    )


def report_roles(report: DataFrame) -> DataFrame:
    """Report back to long rows (series_code, universe, leg, role, role_code)."""
    entries = F.array(
        *[
            F.struct(
                F.lit(leg).alias("leg"),
                F.lit(role).alias("role"),
                F.col(f"{leg}_{role}").alias("role_code"),
            )
            for leg in LEGS
            for role in ROLES
        ]
    )
    return report.select(SERIES_CODE, "universe", F.inline(entries)).filter(
        "role_code IS NOT NULL"
    )


def blocked_summary(report: DataFrame) -> DataFrame:
    """Blocked and total pairs per universe."""
    return report.groupBy("universe").agg(
        F.count_if(F.col("blocked")).alias("blocked"), F.count("*").alias("pairs")
    )
