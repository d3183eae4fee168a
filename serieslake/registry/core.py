"""Catalog, value, reshape and derived-series queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from serieslake.functions.dates import floor_day
from serieslake.functions.text import canonical_source, parent_codes
from serieslake.operators import catalog as cat
from serieslake.operators import derived, quality, reshape, values
from serieslake.operators.joins import small_side
from serieslake.registry import tables as t
from serieslake.registry.base import (
    CATALOG,
    PANEL,
    SPARSE,
    VALS,
    last_wins_sql,
    query,
    rounded,
    views,
)
from serieslake.schema import SEQ, SERIES_CODE, TICKER_SOURCE, TIMESTAMP, VALUE
from serieslake.sources import vendors

LONG = 'series_code, "timestamp", "value"'
ASIA_EUROPE = {"region": ["ASIA", "EUROPE"]}
SEGMENTS = {"asset_class": ["BUILDING", "MACHINERY"], "region": ["ASIA", "EUROPE", "AFRICA"]}


@query(
    "last_value",
    views(CATALOG, VALS)
    + """SELECT series_code, "timestamp", "value" FROM (
      SELECT v.series_code, "timestamp", "value",
             row_number() OVER (PARTITION BY v.series_code ORDER BY "timestamp" DESC, _seq DESC) AS r
      FROM vals v WHERE "value" IS NOT NULL AND "timestamp" BETWEEN '1996-01-01' AND '2000-12-31'
        AND v.series_code IN (SELECT series_code FROM catalog WHERE region IN ('ASIA', 'EUROPE')))
    WHERE r = 1""",
)
def last_value(spark, folder):
    codes = cat.include(t.catalog(spark, folder), ASIA_EUROPE)
    rows = values.scan(
        t.values(spark, folder), codes=codes, start="1996-01-01", end="2000-12-31"
    )
    return values.last_value(rows)


@query(
    "last_value_by_source",
    views(VALS)
    + """SELECT series_code, arg_max("timestamp", ("timestamp", _seq)) AS "timestamp",
       arg_max("value", ("timestamp", _seq)) AS "value"
    FROM vals WHERE ticker_source = 'hawk' GROUP BY 1""",
)
def last_value_by_source(spark, folder):
    return values.last_value(values.scan(t.values(spark, folder), source="HAWKEYE"))


@query(
    "value_scan",
    views(CATALOG, VALS)
    + """SELECT series_code, "timestamp", "value", ticker_source FROM vals
    WHERE series_code IN (SELECT series_code FROM catalog WHERE region IN ('ASIA', 'EUROPE'))""",
)
def value_scan(spark, folder):
    codes = cat.include(t.catalog(spark, folder), ASIA_EUROPE)
    return values.scan(t.values(spark, folder), codes=codes).drop(SEQ)


@query(
    "value_range",
    views(VALS)
    + """SELECT series_code, "timestamp", "value", ticker_source FROM vals
    WHERE "timestamp" >= '1996-03-01' AND "timestamp" <= '1998-02-28'""",
)
def value_range(spark, folder):
    return values.scan(t.values(spark, folder), start="1996-03-01", end="1998-02-28").drop(SEQ)


@query(
    "value_by_source",
    views(VALS) + f"SELECT {LONG} FROM vals WHERE ticker_source = 'bloomberg'",
)
def value_by_source(spark, folder):
    return values.scan(t.values(spark, folder), source="BBG").drop(SEQ, TICKER_SOURCE)


@query(
    "value_topn",
    views(VALS)
    + f"""SELECT {LONG} FROM vals
    ORDER BY "value" DESC, "timestamp", series_code, _seq LIMIT 100""",
)
def value_topn(spark, folder):
    rows = values.scan(t.values(spark, folder), order_by=VALUE, ascending=False, limit=100)
    return rows.drop(SEQ, TICKER_SOURCE)


@query(
    "metadata_filter",
    views(CATALOG)
    + """SELECT * FROM catalog WHERE asset_class IN ('BUILDING', 'MACHINERY')
    AND region IN ('ASIA', 'EUROPE', 'AFRICA')""",
)
def metadata_filter(spark, folder):
    return cat.include(t.catalog(spark, folder), SEGMENTS)


@query(
    "metadata_exclude",
    views(CATALOG)
    + """SELECT * FROM catalog WHERE asset_class NOT IN ('BUILDING') AND rating NOT IN ('high')""",
)
def metadata_exclude(spark, folder):
    return cat.exclude(t.catalog(spark, folder), {"asset_class": ["BUILDING"], "rating": ["high"]})


@query(
    "metadata_narrow_exclude",
    views(CATALOG)
    + """SELECT * FROM catalog WHERE region IN ('ASIA', 'EUROPE')
    AND (rating IS NULL OR rating NOT IN ('high'))""",
)
def metadata_narrow_exclude(spark, folder):
    found = cat.narrow(t.catalog(spark, folder), ASIA_EUROPE)
    return cat.narrow_exclude(found, {"rating": ["high"]})


@query(
    "series_codes",
    views(CATALOG) + "SELECT DISTINCT trim(series_code) AS series_code FROM catalog",
)
def series_codes(spark, folder):
    return cat.series_codes(t.catalog(spark, folder))


@query(
    "value_exists",
    views(VALS) + "SELECT series_code, count(*) > 0 AS has_values FROM vals GROUP BY 1",
)
def value_exists(spark, folder):
    return values.value_exists(t.values(spark, folder))


@query("count_points", views(VALS) + 'SELECT count("value") AS data_points FROM vals')
def count_points(spark, folder):
    return values.count_points(t.values(spark, folder))


@query(
    "count_rows",
    views(CATALOG) + "SELECT region, count(*) AS n FROM catalog GROUP BY 1",
)
def count_rows(spark, folder):
    return t.catalog(spark, folder).groupBy("region").agg(F.count("*").alias("n"))


@query(
    "first_rows",
    views(CATALOG) + "SELECT * FROM catalog ORDER BY series_code LIMIT 10",
)
def first_rows(spark, folder):
    return t.catalog(spark, folder).orderBy(SERIES_CODE).limit(10)


@query("distinct_options", views(CATALOG) + 'SELECT DISTINCT rating AS "value" FROM catalog '
       "WHERE rating IS NOT NULL")
def distinct_options(spark, folder):
    return cat.distinct_options(t.catalog(spark, folder), "rating")


@query(
    "filter_options_all",
    views(CATALOG)
    + """SELECT DISTINCT field, trim("value") AS "value" FROM (
      UNPIVOT (SELECT * FROM catalog) ON series_code, series_name, asset_class, currency, region,
      rating INTO NAME field VALUE "value") WHERE trim("value") <> ''""",
)
def filter_options_all(spark, folder):
    return cat.filter_options(t.catalog(spark, folder))


@query(
    "filter_options_narrowed",
    views(CATALOG)
    + """SELECT DISTINCT 'currency' AS field, currency AS "value" FROM catalog
    WHERE asset_class = 'BUILDING' AND rating IN ('high')""",
)
def filter_options_narrowed(spark, folder):
    found = cat.include(
        t.catalog(spark, folder), {"asset_class": ["BUILDING"], "rating": ["high"]}
    )
    return cat.filter_options(found, "currency")


@query(
    "group_series",
    views(CATALOG, VALS)
    + """SELECT asset_class, rating, count(DISTINCT c.series_code) AS series,
       count("value") AS points, round(max("value"), 2) AS highest
    FROM catalog c JOIN vals v ON c.series_code = v.series_code GROUP BY 1, 2""",
)
def group_series(spark, folder):
    keyed = cat.group_series(t.catalog(spark, folder), ["asset_class", "rating"])
    return (
        t.values(spark, folder)
        .join(small_side(keyed), SERIES_CODE)
        .groupBy("asset_class", "rating")
        .agg(
            F.count_distinct(SERIES_CODE).alias("series"),
            F.count(VALUE).alias("points"),
            F.round(F.max(VALUE), 2).alias("highest"),
        )
    )


@query("last_wins", views(VALS, last_wins_sql("vals")) + f"SELECT {LONG} FROM vals_last")
def last_wins(spark, folder):
    return values.last_wins(t.values(spark, folder))


ROUTES = "CASE hash_key % 3 WHEN 0 THEN 'bloomberg' WHEN 1 THEN 'hawk' ELSE 'mds' END"


def _routed_catalog(spark, folder):
    """Customers with a default vendor in its various spellings."""
    key = F.col("c_custkey") % 3
    spelling = (
        F.when(key == 0, " BBG ").when(key == 1, "Hawkeye").otherwise("onetick")
    )
    return t.load(spark, folder, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias(SERIES_CODE),
        spelling.alias("default_source"),
    )


@query(
    "default_source_routing",
    views(VALS)
    + f"""SELECT v.series_code, "timestamp", "value", ticker_source FROM vals v
    JOIN (SELECT 'C' || c_custkey AS series_code, c_custkey AS hash_key FROM customer) c
    ON v.series_code = c.series_code WHERE ticker_source = {ROUTES}""",
)
def default_source_routing(spark, folder):
    return values.route_by_default_source(
        t.values(spark, folder), _routed_catalog(spark, folder)
    ).select(SERIES_CODE, TIMESTAMP, VALUE, TICKER_SOURCE)


@query(
    "source_aliases",
    """SELECT CASE c_custkey % 3 WHEN 0 THEN 'bloomberg' WHEN 1 THEN 'hawk' ELSE 'mds' END
       AS source, count(*) AS n FROM customer GROUP BY 1""",
)
def source_aliases(spark, folder):
    source = canonical_source(F.col("default_source")).alias("source")
    return _routed_catalog(spark, folder).groupBy(source).agg(F.count("*").alias("n"))


def _cells(codes, digits=4):
    return ", ".join(
        f"round(max(CASE WHEN series_code = '{c}' THEN \"value\" END), {digits}) + 0 AS \"{c}\""
        for c in codes
    )


@query(
    "pivot_values",
    views(PANEL) + f'SELECT "timestamp", {_cells(t.PANEL_CODES)} FROM panel GROUP BY 1',
)
def pivot_values(spark, folder):
    wide = reshape.pivot_values(t.panel(spark, folder), t.PANEL_CODES)
    return wide.select(TIMESTAMP, *[rounded(f"`{c}`", 4).alias(c) for c in t.PANEL_CODES])


@query(
    "pivot_last_wins",
    views(SPARSE, last_wins_sql("sparse"))
    + f'SELECT "timestamp", {_cells(t.PRIORITIES)} FROM sparse_last GROUP BY 1',
)
def pivot_last_wins(spark, folder):
    wide = reshape.pivot_values(t.sparse(spark, folder), t.PRIORITIES)
    return wide.select(TIMESTAMP, *[rounded(f"`{c}`", 4).alias(c) for c in t.PRIORITIES])


@query(
    "melt_values",
    views(SPARSE, last_wins_sql("sparse"))
    + f"SELECT {LONG}, 'bloomberg' AS ticker_source FROM sparse_last",
)
def melt_values(spark, folder):
    wide = reshape.pivot_values(t.sparse(spark, folder), t.PRIORITIES, sort=False)
    return reshape.melt_values(wide, source="bloomberg")


@query(
    "drop_empty_rows",
    views(SPARSE, last_wins_sql("sparse"))
    + """SELECT "timestamp", max(CASE WHEN series_code = '1-URGENT' THEN "value" END) AS urgent,
       max(CASE WHEN series_code = '5-LOW' THEN "value" END) AS low
    FROM sparse_last WHERE series_code IN ('1-URGENT', '5-LOW') GROUP BY 1""",
)
def drop_empty_rows(spark, folder):
    wide = reshape.pivot_values(t.sparse(spark, folder), t.PRIORITIES, sort=False)
    two = wide.select(
        TIMESTAMP, F.col("1-URGENT").alias("urgent"), F.col("5-LOW").alias("low")
    )
    return reshape.drop_empty_rows(two)


@query(
    "rename_series",
    views(CATALOG, VALS)
    + """SELECT series_name, "timestamp", "value" FROM vals v JOIN catalog c
    ON v.series_code = c.series_code""",
)
def rename_series(spark, folder):
    renamed = reshape.relabel(t.values(spark, folder), t.catalog(spark, folder), "series_name")
    return renamed.select("series_name", TIMESTAMP, VALUE)


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query(
    "matrix_by_label",
    "SELECT o_orderdate AS \"timestamp\", "
    + ", ".join(
        f"max(CASE WHEN r_name = '{r}' THEN v END) AS \"{r}\"" for r in REGIONS
    )
    + """ FROM (SELECT r_name, o_orderdate, max(o_totalprice) AS v
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2) GROUP BY 1""",
)
def matrix_by_label(spark, folder):
    """One series per region (its largest order of the day), columns named by region."""
    catalog = t.catalog(spark, folder)
    long = (
        t.values(spark, folder)
        .join(catalog.select(SERIES_CODE, "region"), SERIES_CODE)
        .groupBy(F.concat(F.lit("MAX_"), F.col("region")).alias(SERIES_CODE), TIMESTAMP)
        .agg(F.max(VALUE).alias(VALUE))
    )
    labels = catalog.select(
        F.concat(F.lit("MAX_"), F.col("region")).alias(SERIES_CODE),
        F.col("region").alias("currency"),
    ).distinct()
    return reshape.matrix_by_label(long, labels)


@query(
    "metadata_union",
    views(CATALOG)
    + """SELECT series_code, asset_class, region,
       CASE WHEN region = 'ASIA' THEN 'first' WHEN asset_class = 'BUILDING' THEN 'second'
            ELSE 'third' END AS origin FROM catalog""",
)
def metadata_union(spark, folder):
    found = t.catalog(spark, folder).select(SERIES_CODE, "asset_class", "region")
    first = cat.include(found, {"region": ["ASIA"]}).withColumn("origin", F.lit("first"))
    second = cat.include(found, {"asset_class": ["BUILDING"]}).withColumn(
        "origin", F.lit("second")
    )
    return cat.union_first_wins(first, second, found.withColumn("origin", F.lit("third")))


@query(
    "widen_union",
    views(CATALOG)
    + """SELECT series_code, region, CAST(NULL AS VARCHAR) AS rating, currency FROM catalog
      WHERE region = 'ASIA'
    UNION ALL SELECT series_code, region, rating, NULL FROM catalog WHERE region = 'EUROPE'""",
)
def widen_union(spark, folder):
    found = t.catalog(spark, folder)
    first = cat.include(found, {"region": ["ASIA"]}).select(SERIES_CODE, "region", "currency")
    second = cat.include(found, {"region": ["EUROPE"]}).select(SERIES_CODE, "region", "rating")
    return cat.widen_union(first, second)


# -- derived series ------------------------------------------------------------------------

WIDE = "wide AS (SELECT \"timestamp\", " + ", ".join(
    f"max(CASE WHEN series_code = '{c}' THEN \"value\" END) AS {c}" for c in t.PANEL_CODES
) + " FROM panel GROUP BY 1)"
FORMULAS = {
    "SPREAD": "A_F - A_O",
    "FLY": "A_F - 2.0 * N_O + R_F",
    "BOX": "A_F - A_O - R_F + R_O",
    "RATIO": "CASE WHEN A_F <> 0 THEN N_O / A_F END",
    "SPREAD_INV": "R_O - R_F",
    "RATIO_INV": "CASE WHEN R_O <> 0 THEN N_O / R_O END",
}
PARENTS = {
    "SPREAD": ("A_F", "A_O"),
    "FLY": ("A_F", "N_O", "R_F"),
    "BOX": ("A_F", "A_O", "R_F", "R_O"),
    "RATIO": ("N_O", "A_F"),
    "SPREAD_INV": ("R_F", "R_O"),
    "RATIO_INV": ("R_O", "N_O"),
}
LOG_SQL = """logs AS (
  SELECT "timestamp", ln("value") - lag(ln("value")) OVER (ORDER BY "timestamp") AS r
  FROM panel WHERE series_code = 'N_O' AND "value" > 0),
log_vol AS (
  SELECT "timestamp", stddev_samp(r) OVER w * sqrt(252) * 100 AS v, count(r) OVER w AS n
  FROM logs WINDOW w AS (ORDER BY "timestamp" ROWS BETWEEN 20 PRECEDING AND CURRENT ROW))"""


def _formula_sql(kind):
    known = " AND ".join(f"{c} IS NOT NULL" for c in PARENTS[kind])
    return (
        f"SELECT 'D_{kind}' AS series_code, \"timestamp\", "
        f'round({FORMULAS[kind]}, 4) + 0 AS "value" FROM wide WHERE {known}'
    )


LOG_SELECT = (
    "SELECT 'D_LOG' AS series_code, \"timestamp\", round(v, 4) + 0 AS \"value\" "
    "FROM log_vol WHERE n = 21"
)


def _derive(kinds):
    def run(spark, folder):
        result = derived.derive_series(
            t.panel(spark, folder), t.dependencies(spark, folder, kinds)
        )
        return result.withColumn(VALUE, rounded(VALUE, 4))

    return run


for _kind in FORMULAS:
    query(f"derived_{_kind.lower()}", views(PANEL, WIDE) + _formula_sql(_kind))(_derive([_kind]))
query("derived_log_vol", views(PANEL, LOG_SQL) + LOG_SELECT)(_derive(["LOG"]))
query(
    "derived_batch",
    views(PANEL, WIDE, LOG_SQL)
    + " UNION ALL ".join([_formula_sql(kind) for kind in FORMULAS] + [LOG_SELECT]),
)(_derive(None))


@query(
    "derived_log_vol_daily_orders",
    """WITH d AS (SELECT o_orderpriority AS series_code, o_orderdate AS "timestamp",
        avg(o_totalprice) AS x FROM orders GROUP BY 1, 2),
    r AS (SELECT *, ln(x) - lag(ln(x)) OVER (PARTITION BY series_code ORDER BY "timestamp") AS r
        FROM d),
    v AS (SELECT series_code, "timestamp", stddev_samp(r) OVER w * sqrt(252) * 100 AS v,
        count(r) OVER w AS n FROM r WINDOW w AS (PARTITION BY series_code ORDER BY "timestamp"
        ROWS BETWEEN 20 PRECEDING AND CURRENT ROW))
    SELECT series_code, "timestamp", round(v, 6) + 0 AS "value" FROM v WHERE n = 21""",
)
def derived_log_vol_daily_orders(spark, folder):
    """Log volatility with very small chunks, so that chunk borders are crossed often."""
    from serieslake.operators.rolling import log_return_volatility

    daily = (
        t.sparse(spark, folder).groupBy(SERIES_CODE, TIMESTAMP).agg(F.avg(VALUE).alias(VALUE))
    )
    return log_return_volatility(daily, chunk_size=100).withColumn(VALUE, rounded(VALUE))


@query(
    "derived_split",
    """SELECT DISTINCT l_returnflag || '_' || l_linestatus AS series_code, 'primary' AS kind
       FROM lineitem
    UNION ALL SELECT 'D_' || k, 'derived' FROM (VALUES ('SPREAD'), ('FLY'), ('BOX'), ('RATIO'),
      ('SPREAD_INV'), ('RATIO_INV'), ('LOG')) AS v(k)""",
)
def derived_split(spark, folder):
    needed = t.dependencies(spark, folder)
    wanted = (
        t.panel(spark, folder).select(SERIES_CODE).union(needed.select(SERIES_CODE)).distinct()
    )
    found, primary = derived.split_derived(wanted, needed)
    return primary.withColumn("kind", F.lit("primary")).union(
        found.withColumn("kind", F.lit("derived"))
    )


@query(
    "parent_list",
    """SELECT DISTINCT l_returnflag || '_' || l_linestatus AS series_code FROM lineitem
    WHERE l_returnflag || '_' || l_linestatus IN ('A_F', 'A_O', 'N_O', 'R_F', 'R_O')""",
)
def parent_list(spark, folder):
    return derived.parent_list(t.dependencies(spark, folder))


@query(
    "parent_codes",
    """SELECT p_partkey AS part, 2 + (p_size % 2) AS parents,
       p_brand || '>' || p_type || CASE WHEN p_size % 2 = 1 THEN '>' || p_name ELSE '' END AS path
    FROM part""",
)
def parsed_parents(spark, folder):
    """Pipe-delimited lists with blanks, split and cleaned."""
    text = F.concat(
        F.lit(" | "), F.col("p_brand"), F.lit(" | "), F.col("p_type"), F.lit("|"),
        F.when(F.col("p_size") % 2 == 1, F.col("p_name")).otherwise("  "),
    )
    codes = parent_codes(text)
    return t.load(spark, folder, "part").select(
        F.col("p_partkey").alias("part"),
        F.size(codes).alias("parents"),
        F.array_join(codes, ">").alias("path"),
    )


# -- vendor reads --------------------------------------------------------------------------

QUOTES = """quotes AS (
  SELECT n_name AS ticker, date_trunc('month', o_orderdate) AS "timestamp",
         round(avg(o_totalprice) / 1.03, 4) AS "value"
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""


def _quotes(spark, folder):
    nation = F.col("currency").alias("ticker")
    priced = t.values(spark, folder).join(
        t.catalog(spark, folder).select(SERIES_CODE, "currency"), SERIES_CODE
    )
    month = floor_day(F.date_trunc("month", TIMESTAMP)).alias(TIMESTAMP)
    return priced.groupBy(nation, month).agg(F.round(F.avg(VALUE) / 1.03, 4).alias(VALUE))


@query(
    "ticker_fanout",
    views(QUOTES)
    + """SELECT 'C' || c_custkey AS series_code, "timestamp", "value" FROM quotes
    JOIN nation ON n_name = ticker JOIN customer ON c_nationkey = n_nationkey""",
)
def ticker_fanout(spark, folder):
    """Customers share their nation's ticker: one quote serves many series."""
    mapping = t.catalog(spark, folder).select(SERIES_CODE, F.col("currency").alias("ticker"))
    return vendors.fan_out(_quotes(spark, folder), mapping)


@query(
    "live_read",
    views(QUOTES)
    + """SELECT 'C' || c_custkey AS series_code, "timestamp", "value" FROM quotes
    JOIN nation ON n_name = ticker JOIN customer ON c_nationkey = n_nationkey
    WHERE c_acctbal >= 5000 AND "timestamp" >= '1997-01-01' AND "timestamp" <= '1999-12-31'""",
)
def live_read(spark, folder):
    catalog = t.catalog(spark, folder).select(
        SERIES_CODE, "rating", F.col("currency").alias("mds_ticker"),
        F.lit("PX_LAST").alias("mds_field"),
    )
    registry = vendors.VendorRegistry({"OneTick": vendors.table_reader(_quotes(spark, folder))})
    wanted = cat.series_codes(cat.include(catalog, {"rating": ["high"]}))
    return vendors.live_values(
        registry, catalog, wanted, "mds", start="1997-01-01", end="1999-12-31"
    )


# -- quality -------------------------------------------------------------------------------

DIRTY = """dirty AS (
  SELECT CASE WHEN c_custkey % 50 = 7 THEN NULL WHEN c_custkey % 40 = 3 THEN '  '
              ELSE 'S' || CAST(c_custkey - (c_custkey % 20 = 0)::INT AS VARCHAR) END AS series_code,
         CASE WHEN c_acctbal < -500 THEN NULL ELSE c_name END AS series_name,
         CASE WHEN c_nationkey > 3 THEN 'T' || c_nationkey END AS bbg_ticker,
         CASE WHEN c_nationkey > 5 THEN 'PX_LAST' END AS bbg_field,
         CASE WHEN c_custkey % 9 = 0 THEN DATE '2001-01-01' ELSE DATE '1999-01-01' END AS valid_from,
         DATE '2000-01-01' AS valid_to
  FROM customer)"""


def _dirty_catalog(spark, folder):
    key = F.col("c_custkey")
    code = F.concat(F.lit("S"), (key - (key % 20 == 0).cast("int")).cast("string"))
    return t.load(spark, folder, "customer").select(
        F.when(key % 50 == 7, None).when(key % 40 == 3, "  ").otherwise(code).alias(SERIES_CODE),
        F.when(F.col("c_acctbal") >= -500, F.col("c_name")).alias("series_name"),
        F.when(
            F.col("c_nationkey") > 3, F.concat(F.lit("T"), F.col("c_nationkey").cast("string"))
        ).alias("bbg_ticker"),
        F.when(F.col("c_nationkey") > 5, "PX_LAST").alias("bbg_field"),
        F.when(key % 9 == 0, "2001-01-01").otherwise("1999-01-01").alias("valid_from"),
        F.lit("2000-01-01T00:00:00").alias("valid_to"),
    )


@query(
    "quality_metadata",
    views(DIRTY)
    + """SELECT category, count(*) AS failures FROM (
      SELECT 'null' AS category FROM dirty WHERE series_code IS NULL
      UNION ALL SELECT 'null' FROM dirty WHERE trim(series_code) = ''
      UNION ALL SELECT 'null' FROM dirty WHERE series_name IS NULL
      UNION ALL SELECT 'pairing' FROM dirty WHERE (bbg_ticker IS NULL) <> (bbg_field IS NULL)
      UNION ALL SELECT 'other' FROM dirty WHERE valid_from > valid_to
      UNION ALL SELECT 'duplicate' FROM dirty WHERE series_code IS NOT DISTINCT FROM NULL
        AND (SELECT count(*) FROM dirty WHERE series_code IS NULL) > 1
      UNION ALL SELECT 'duplicate' FROM dirty WHERE series_code IN (
        SELECT series_code FROM dirty GROUP BY 1 HAVING count(*) > 1)) GROUP BY 1""",
)
def quality_metadata(spark, folder):
    failures = quality.metadata_failures(_dirty_catalog(spark, folder))
    return quality.failure_counts(failures).withColumn("failures", F.col("failures").cast("bigint"))


@query(
    "quality_values",
    """WITH v AS (SELECT 'C' || o_custkey AS series_code, o_orderdate AS ts,
        CASE WHEN o_custkey % 10 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'inf'::DOUBLE
             ELSE o_totalprice END AS x FROM orders),
    t AS (SELECT series_code, ts, count(*) AS n, count(x) AS known,
        count(*) FILTER (x = 'inf'::DOUBLE) AS infinite FROM v GROUP BY 1, 2),
    s AS (SELECT series_code, sum(known) AS known, sum(infinite) AS infinite,
        count(*) FILTER (n > 1) AS repeated, count(*) FILTER (ts > '2001-01-01') AS future
        FROM t GROUP BY 1)
    SELECT series_code, 'series has no data' AS "check", 1::BIGINT AS n FROM s WHERE known = 0
    UNION ALL SELECT series_code, 'value is not finite', infinite::BIGINT FROM s WHERE infinite > 0
    UNION ALL SELECT series_code, 'timestamp is repeated', repeated::BIGINT FROM s
      WHERE repeated > 0
    UNION ALL SELECT series_code, 'timestamp is in the future', future::BIGINT FROM s
      WHERE future > 0""",
)
def quality_values(spark, folder):
    orders = t.load(spark, folder, "orders")
    value = (
        F.when(F.col("o_custkey") % 10 == 0, None)
        .when(F.col("o_orderkey") % 97 == 0, float("inf"))
        .otherwise(F.col("o_totalprice"))
    )
    rows = orders.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias(SERIES_CODE),
        F.col("o_orderdate").alias(TIMESTAMP),
        value.alias(VALUE),
    )
    return quality.value_failures(rows, now=F.lit("2001-01-01").cast("timestamp_ntz"))


@query(
    "freshness",
    views(VALS)
    + """SELECT series_code, max("timestamp") AS latest,
       date_diff('day', max("timestamp"), TIMESTAMP '2001-08-01') AS age_days,
       date_diff('day', max("timestamp"), TIMESTAMP '2001-08-01') <= 3 AS is_fresh
    FROM vals GROUP BY 1""",
)
def freshness(spark, folder):
    as_of = F.lit("2001-08-01").cast("timestamp_ntz")
    rows = quality.freshness(t.values(spark, folder), as_of)
    return rows.withColumn("age_days", F.col("age_days").cast("bigint"))


@query(
    "allowed_values",
    views(CATALOG)
    + """SELECT field, "value", count(*) AS n FROM (
      SELECT 'asset_class' AS field, asset_class AS "value" FROM catalog
      UNION ALL SELECT 'region', region FROM catalog)
    WHERE "value" NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE', 'ASIA', 'EUROPE') GROUP BY 1, 2""",
)
def allowed_values(spark, folder):
    allowed = {
        "asset_class": ["BUILDING", "MACHINERY", "AUTOMOBILE"],
        "region": ["ASIA", "EUROPE"],
    }
    return quality.disallowed_values(
        t.catalog(spark, folder), allowed, ["asset_class", "region"]
    )


@query(
    "duplicate_tickers",
    views(DIRTY)
    + """SELECT bbg_ticker, bbg_field, count(DISTINCT series_code) AS series FROM dirty
    WHERE bbg_ticker IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT series_code) > 1""",
)
def duplicate_tickers(spark, folder):
    return quality.duplicate_tickers(_dirty_catalog(spark, folder), "bbg_ticker", "bbg_field")


@query(
    "ticker_selection",
    views(DIRTY) + "SELECT series_code, bbg_ticker FROM dirty WHERE bbg_ticker IS NOT NULL",
)
def ticker_selection(spark, folder):
    return cat.ticker_selection(_dirty_catalog(spark, folder), "bbg_ticker").select(
        SERIES_CODE, "bbg_ticker"
    )
