"""The shared test tables seen as catalogs and values of a series lake.

* catalog and values: one series per customer, one value per order;
* panel: six dense daily series from line items; sparse panel: five from orders;
* ticks: five sub-daily series from events;
* a currency world: one currency per nation, its series from line items of its suppliers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from serieslake.plans.universes import (
    BUY_SELL_SERIES,
    COMMODITY_SERIES,
    GLOBAL_EQUITY_SERIES,
    OFFSHORE_SERIES,
    ONSHORE_SERIES,
    TURNOVER_SERIES,
)
from serieslake.schema import (
    BLOOMBERG,
    HAWK,
    MDS,
    SEQ,
    SERIES_CODE,
    SERIES_NAME,
    TICKER_SOURCE,
    TIMESTAMP,
    VALUE,
)

PANEL_CODES = ["A_F", "A_O", "N_F", "N_O", "R_F", "R_O"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FLOW_CODES = dict(zip(PANEL_CODES, [*BUY_SELL_SERIES.values(), *TURNOVER_SERIES.values()]))
FLOWS_END = "1998-06-30"


_SCHEMAS: dict[str, StructType] = {}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A shared table; its schema is looked up once per file."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer; ``rating`` is missing for overdrawn ones."""
    nation = load(spark, folder, "nation").join(
        load(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rating = F.when(F.col("c_acctbal") >= 5000, "high").when(F.col("c_acctbal") >= 0, "low")
    return (
        load(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias(SERIES_CODE),
            F.col("c_name").alias(SERIES_NAME),
            F.col("c_mktsegment").alias("asset_class"),
            F.col("n_name").alias("currency"),
            F.col("r_name").alias("region"),
            rating.alias("rating"),
        )
    )


def source_of(status: Column) -> Column:
    return F.when(status == "O", BLOOMBERG).when(status == "F", HAWK).otherwise(MDS)


def values(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order; some (customer, day) pairs occur more than once."""
    return load(spark, folder, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias(SERIES_CODE),
        F.col("o_orderdate").alias(TIMESTAMP),
        F.col("o_totalprice").alias(VALUE),
        source_of(F.col("o_orderstatus")).alias(TICKER_SOURCE),
        F.col("o_orderkey").alias(SEQ),
    )


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """Mean price per return flag, line status and day. Here and below, odd divisors keep
    values off rounding ties, where two engines may legitimately differ."""
    return (
        load(spark, folder, "lineitem")
        .groupBy(
            F.concat_ws("_", "l_returnflag", "l_linestatus").alias(SERIES_CODE),
            F.col("l_shipdate").alias(TIMESTAMP),
        )
        .agg((F.avg("l_extendedprice") / 1.03).alias(VALUE))
    )


def sparse(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order under its priority: repeats within a day, days without data."""
    return load(spark, folder, "orders").select(
        F.col("o_orderpriority").alias(SERIES_CODE),
        F.col("o_orderdate").alias(TIMESTAMP),
        F.col("o_totalprice").alias(VALUE),
        F.col("o_orderkey").alias(SEQ),
    )


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select(
        F.col("event_type").alias(SERIES_CODE),
        F.col("ts").alias(TIMESTAMP),
        VALUE,
        F.col("event_id").alias(SEQ),
    )


def currency_code(key: Column) -> Column:
    letters = F.concat(
        F.lit("N"), F.char(F.floor(key / 5) + 65), F.char((key % 5) + 65)
    )
    return F.when(key == 0, "USD").when(key == 2, "CNH").otherwise(letters)


def fx_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog of the currency world.

    Holes on purpose: nation 4 has no credit series, nation 8 no ten-year yield; region 4 has
    crosses without a USD leg; one code is no pair. Every supplier adds a synthetic equity
    index that must lose against the nation's own.
    """
    key = F.col("n_nationkey")
    ccy = currency_code(key)
    development = (
        F.when(key == 2, "CHN")
        .when((key == 0) | F.col("n_regionkey").isin(1, 3), "G10")
        .otherwise("EM")
    )
    names = (
        SERIES_CODE, "asset_class", "sub_asset_class", "market_development", "currency",
        "tenor", "market_segment", "is_synthetic", "valid_to",
    )

    def row(code, asset, sub, dev, currency, tenor=None, segment=None, synthetic="False", end=None):
        cells = (code, asset, sub, dev, currency, tenor, segment, synthetic, end)
        columns = [c if isinstance(c, Column) else F.lit(c).cast("string") for c in cells]
        return F.struct(*[c.alias(n) for n, c in zip(names, columns)])

    def code(suffix: str) -> Column:
        return F.concat(ccy, F.lit(f"_{suffix}_PX_LAST"))

    nation = load(spark, folder, "nation")
    rows = [
        F.when(
            key != 0,
            row(F.concat(F.lit("USD"), ccy, F.lit("_PX_LAST")), "Currency", "FX Spot", development, ccy),
        ),
        F.when(
            F.col("n_regionkey") == 4,
            row(F.concat(ccy, F.lit("CNH_PX_LAST")), "Currency", "FX Spot", "EM", ccy),
        ),
        F.when(key == 10, row(F.concat(F.lit("X_"), F.col("n_name")), "Currency", "FX Spot", "G10", ccy)),
        row(code("SWAP"), "Rates", "Interest Rate Swap", development, ccy, "2Y"),
        row(code("3M"), "Rates", "Money Market Rate", development, ccy, "3M"),
        F.when(key != 8, row(code("10Y"), "Rates", "Sovereign Yield", development, ccy, "10Y")),
        F.when(key != 4, row(code("CDS"), "Credit", "Sovereign CDS", development, ccy, "5Y")),
        row(code("EQ"), "Equity", "Equity Index", development, ccy, None, "Local"),
    ]
    rows += [
        F.when(key == 2, row(c, "Currency", "FX Forward", "CHN", ccy))
        for c in (OFFSHORE_SERIES, ONSHORE_SERIES)
    ]
    rows += [
        F.when(key == 2, row(c, "Flows", "Equity Flow", "CHN", ccy, end=FLOWS_END))
        for c in BUY_SELL_SERIES.values()
    ]
    rows += [
        F.when(key == 2, row(c, "Flows", "Equity Flow", "CHN", ccy))
        for c in TURNOVER_SERIES.values()
    ]
    real = nation.select(F.explode(F.array(*rows)).alias("r")).filter("r IS NOT NULL").select("r.*")
    synthetic = (
        load(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == key)
        .select(
            row(
                F.concat(F.lit("A"), F.col("s_suppkey").cast("string"), F.lit("_EQ_PX_LAST")),
                "Equity", "Equity Index", development, ccy, None, "Local", "True",
            ).alias("r")
        )
        .select("r.*")
    )
    return real.unionByName(synthetic)


def fx_values(spark: SparkSession, folder: str) -> DataFrame:
    """Daily values of the currency world, all from one scan of the line items.

    Lines are first added up per nation, flag, status and day, a number of groups only the
    calendar bounds. Each group then counts towards its nation, its flag and status, its flag,
    and the world: one more aggregate, over a group number. A line counts once for its flag and the
    world, with or without a supplier, and for a nation as often as suppliers of its key are there.
    """
    flag = F.position(F.col("l_returnflag"), F.lit("ANR"))
    status = F.position(F.col("l_linestatus"), F.lit("FO"))
    flow_base, basis_base, world_group = 1_000_000, 2_000_000, 3_000_000
    whole = F.array(flow_base + flag * 10 + status, basis_base + flag, F.lit(world_group))
    groups = F.when(F.col("nations").isNull(), whole).otherwise(F.concat("nations", whole))
    sums = {
        "price": "l_extendedprice",
        "discount": "l_discount",
        "tax": "l_tax",
        "quantity": "l_quantity",
    }
    cells = (
        supplied_lines(spark, folder)
        .groupBy("nations", "l_returnflag", "l_linestatus", F.col("l_shipdate").alias(TIMESTAMP))
        .agg(
            F.max("l_quantity").alias("top"),
            *[F.count(column).alias(f"n_{name}") for name, column in sums.items()],
            *[F.sum(column).alias(name) for name, column in sums.items()],
        )
    )
    lines = (
        cells.select("*", F.explode(groups).alias("g"))
        .groupBy("g", TIMESTAMP)
        .agg(
            F.max("top").alias("top"),
            *[F.sum(f"n_{name}").alias(f"n_{name}") for name in sums],
            *[F.sum(name).alias(name) for name in sums],
        )
    )
    group = F.col("g")
    ccy = currency_code(group)

    def mean(column: str, unit: float = 1.0) -> Column:
        return F.col(column) / F.nullif(F.col(f"n_{column}"), F.lit(0)) / unit

    def entry(condition: Column, code: Column | str, value: Column) -> Column:
        label = F.lit(code) if isinstance(code, str) else code
        return F.when(condition, F.struct(label.alias(SERIES_CODE), value.alias(VALUE)))

    is_nation = group < flow_base
    per_nation = {
        "SWAP": mean("discount", 0.0103),
        "3M": mean("tax", 0.0097),
        "10Y": mean("quantity", 10.3),
        "CDS": F.col("top"),
        "EQ": F.col("price") / 1000,
    }
    flow_places = {
        code: flow_base + (1 + "ANR".index(combo[0])) * 10 + 1 + "FO".index(combo[2])
        for combo, code in FLOW_CODES.items()
    }
    entries = [
        entry(
            is_nation & (group != 0),
            F.concat(F.lit("USD"), ccy, F.lit("_PX_LAST")),
            mean("price", 9973.0),
        ),
        *[
            entry(is_nation, F.concat(ccy, F.lit(f"_{suffix}_PX_LAST")), value)
            for suffix, value in per_nation.items()
        ],
        *[entry(group == place, code, F.col("quantity")) for code, place in flow_places.items()],
        entry(group == basis_base + 3, OFFSHORE_SERIES, mean("discount", 0.0103)),
        entry(group == basis_base + 2, ONSHORE_SERIES, mean("discount", 0.0103)),
        entry(group == world_group, GLOBAL_EQUITY_SERIES, mean("price", 1.03)),
    ]
    from_lines = (
        lines.select(TIMESTAMP, F.explode(F.array(*entries)).alias("e"))
        .filter("e IS NOT NULL")
        .select(f"e.{SERIES_CODE}", TIMESTAMP, f"e.{VALUE}")
    )
    oil = (
        load(spark, folder, "orders")
        .groupBy(F.col("o_orderdate").alias(TIMESTAMP))
        .agg((F.avg("o_totalprice") / 997).alias(VALUE))
        .select(F.explode(F.array(F.lit(COMMODITY_SERIES))).alias(SERIES_CODE), TIMESTAMP, VALUE)
    )
    return from_lines.unionByName(oil)


def supplied_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All line items, with the nations of the suppliers of their key (null without a supplier)."""
    suppliers = (
        load(spark, folder, "supplier")
        .groupBy("s_suppkey")
        .agg(F.sort_array(F.collect_list("s_nationkey")).alias("nations"))
    )
    return load(spark, folder, "lineitem").join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left"
    )


def dependencies(spark: SparkSession, folder: str, kinds: list[str] | None = None) -> DataFrame:
    """Derived series over the panel. The series named in the formulas are panel codes that
    exist in the data, so the table is derived from it and not typed in."""
    recipes = {
        "SPREAD": "A_F|A_O",
        "FLY": "A_F | N_O | R_F",
        "BOX": "A_F|A_O|R_F|R_O",
        "RATIO": "N_O|A_F",
        "SPREAD_INV": "R_F|R_O",
        "RATIO_INV": "R_O|N_O",
        "LOG": "N_O",
    }
    chosen = {k: v for k, v in recipes.items() if kinds is None or k in kinds}
    codes = (
        load(spark, folder, "lineitem")
        .select(F.concat_ws("_", "l_returnflag", "l_linestatus").alias("code"))
        .distinct()
    )
    rows = F.array(
        *[
            F.when(
                F.col("code") == parents.split("|")[0].strip(),
                F.struct(
                    F.lit(f"D_{kind}").alias(SERIES_CODE),
                    F.lit(parents).alias("parent_series_code"),
                    F.lit(kind.lower()).alias("calc_type"),
                ),
            )
            for kind, parents in chosen.items()
        ]
    )
    return codes.select(F.explode(rows).alias("r")).filter("r IS NOT NULL").select("r.*")
