"""Queries of the currency fair-value model, on the currency world of the test tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import functions as F

from serieslake.functions.text import (
    base_currency,
    non_usd_leg,
    quote_currency,
    split_names,
)
from serieslake.operators.quality import drop_failing, failing_keys
from serieslake.plans import discovery, drivers, estimation, model, results, signals
from serieslake.plans.universes import BUY_SELL_SERIES, FX_CHN, TURNOVER_SERIES, UNIVERSES
from serieslake.registry import tables as t
from serieslake.registry import fits
from serieslake.registry.base import figure, query, rounded, views
from serieslake.schema import SERIES_CODE
from serieslake.session import cut_lineage

CCY = """CASE n_nationkey WHEN 0 THEN 'USD' WHEN 2 THEN 'CNH'
  ELSE 'N' || chr(65 + n_nationkey // 5) || chr(65 + n_nationkey % 5) END"""
_FLOW_ROWS = "\n".join(
    f"  UNION ALL SELECT '{code}', 'Flows', 'Equity Flow', 'CHN', 'CNH', NULL, NULL, 'False', {end} FROM nat WHERE k = 2"
    for codes, end in (
        (BUY_SELL_SERIES.values(), f"'{t.FLOWS_END}'"),
        (TURNOVER_SERIES.values(), "NULL"),
    )
    for code in codes
)
FX_CATALOG = f"""nat AS (
  SELECT n_nationkey AS k, n_name, n_regionkey AS r, {CCY} AS ccy,
         CASE WHEN n_nationkey = 2 THEN 'CHN' WHEN n_nationkey = 0 OR n_regionkey IN (1, 3)
              THEN 'G10' ELSE 'EM' END AS dev FROM nation),
fxcat AS (
  SELECT 'USD' || ccy || '_PX_LAST' AS series_code, 'Currency' AS asset_class,
         'FX Spot' AS sub_asset_class, dev AS market_development, ccy AS currency,
         CAST(NULL AS VARCHAR) AS tenor, CAST(NULL AS VARCHAR) AS market_segment,
         'False' AS is_synthetic, CAST(NULL AS VARCHAR) AS valid_to FROM nat WHERE k <> 0
  UNION ALL SELECT ccy || 'CNH_PX_LAST', 'Currency', 'FX Spot', 'EM', ccy, NULL, NULL, 'False', NULL
    FROM nat WHERE r = 4
  UNION ALL SELECT 'X_' || n_name, 'Currency', 'FX Spot', 'G10', ccy, NULL, NULL, 'False', NULL
    FROM nat WHERE k = 10
  UNION ALL SELECT ccy || '_SWAP_PX_LAST', 'Rates', 'Interest Rate Swap', dev, ccy, '2Y', NULL,
    'False', NULL FROM nat
  UNION ALL SELECT ccy || '_3M_PX_LAST', 'Rates', 'Money Market Rate', dev, ccy, '3M', NULL,
    'False', NULL FROM nat
  UNION ALL SELECT ccy || '_10Y_PX_LAST', 'Rates', 'Sovereign Yield', dev, ccy, '10Y', NULL,
    'False', NULL FROM nat WHERE k <> 8
  UNION ALL SELECT ccy || '_CDS_PX_LAST', 'Credit', 'Sovereign CDS', dev, ccy, '5Y', NULL,
    'False', NULL FROM nat WHERE k <> 4
  UNION ALL SELECT ccy || '_EQ_PX_LAST', 'Equity', 'Equity Index', dev, ccy, NULL, 'Local',
    'False', NULL FROM nat
  UNION ALL SELECT c, 'Currency', 'FX Forward', 'CHN', 'CNH', NULL, NULL, 'False', NULL FROM nat,
    (VALUES ('OFFSHORE_SPREAD_PX_LAST'), ('ONSHORE_SPREAD_PX_LAST')) AS v(c) WHERE k = 2
{_FLOW_ROWS}
  UNION ALL SELECT 'A' || s_suppkey || '_EQ_PX_LAST', 'Equity', 'Equity Index', dev, ccy, NULL,
    'Local', 'True', NULL FROM supplier JOIN nat ON s_nationkey = k)"""
_FLOW_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in t.FLOW_CODES.items())
FX_VALUES = f"""nd AS (
  SELECT s_nationkey AS n_nationkey, l_shipdate AS d, avg(l_extendedprice) / 9973 AS px,
         avg(l_discount) / 0.0103 AS sw, avg(l_tax) / 0.0097 AS m3, avg(l_quantity) / 10.3 AS y10,
         max(l_quantity) AS cds, sum(l_extendedprice) / 1000 AS eq
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
fxval AS (
  SELECT 'USD' || {CCY} || '_PX_LAST' AS series_code, d, px AS v FROM nd WHERE n_nationkey <> 0
  UNION ALL SELECT {CCY} || '_SWAP_PX_LAST', d, sw FROM nd
  UNION ALL SELECT {CCY} || '_3M_PX_LAST', d, m3 FROM nd
  UNION ALL SELECT {CCY} || '_10Y_PX_LAST', d, y10 FROM nd
  UNION ALL SELECT {CCY} || '_CDS_PX_LAST', d, cds FROM nd
  UNION ALL SELECT {CCY} || '_EQ_PX_LAST', d, eq FROM nd
  UNION ALL SELECT CASE l_returnflag || '_' || l_linestatus {_FLOW_CASE} END, l_shipdate,
    sum(l_quantity) FROM lineitem GROUP BY 1, 2
  UNION ALL SELECT CASE l_returnflag WHEN 'R' THEN 'OFFSHORE_SPREAD_PX_LAST'
    ELSE 'ONSHORE_SPREAD_PX_LAST' END, l_shipdate, avg(l_discount) / 0.0103
    FROM lineitem WHERE l_returnflag IN ('R', 'N') GROUP BY 1, 2
  UNION ALL SELECT 'MXWO_PX_LAST', l_shipdate, avg(l_extendedprice) / 1.03 FROM lineitem GROUP BY 1, 2
  UNION ALL SELECT 'BRENT_PX_LAST', o_orderdate, avg(o_totalprice) / 997 FROM orders GROUP BY 1, 2)"""

ROLE_CASE = """CASE WHEN sub_asset_class = 'Interest Rate Swap' AND tenor = '2Y' THEN 'swap_2y'
  WHEN sub_asset_class = 'Money Market Rate' AND tenor = '3M' THEN 'rate_3m'
  WHEN sub_asset_class = 'Sovereign Yield' AND tenor = '10Y' THEN 'yield_10y'
  WHEN sub_asset_class = 'Sovereign CDS' AND tenor = '5Y' THEN 'cds_5y'
  WHEN sub_asset_class = 'Equity Index' AND market_segment = 'Local' THEN 'local_equity' END"""
ROLES = f"""roles AS (
  SELECT role, currency, arg_min(series_code, (is_synthetic, series_code)) AS role_code
  FROM (SELECT *, {ROLE_CASE} AS role FROM fxcat) WHERE role IS NOT NULL GROUP BY 1, 2)"""
FX_PAIRS = """fxpairs AS (
  SELECT DISTINCT series_code, market_development AS universe,
         nullif(regexp_extract(series_code, '^([A-Z]{3})([A-Z]{3})_', 1), '') AS base,
         nullif(regexp_extract(series_code, '^([A-Z]{3})([A-Z]{3})_', 2), '') AS quote
  FROM fxcat WHERE asset_class = 'Currency' AND sub_asset_class = 'FX Spot'
    AND market_development IN ('G10', 'EM', 'CHN'))"""
NEEDS = f"""usd AS (SELECT *, CASE WHEN base = 'USD' AND quote <> 'USD' THEN 'quote'
    WHEN quote = 'USD' AND base <> 'USD' THEN 'base' END AS leg FROM fxpairs),
needs AS (
  SELECT series_code, universe, place + CASE l WHEN 'base' THEN 0 ELSE
           CASE universe WHEN 'G10' THEN 4 ELSE 2 END END AS place, l AS leg, role,
         CASE l WHEN 'base' THEN base ELSE quote END AS currency
  FROM usd, (VALUES ('base'), ('quote')) AS legs(l),
    (VALUES ('G10', 0, 'swap_2y'), ('G10', 1, 'rate_3m'), ('G10', 2, 'yield_10y'),
            ('G10', 3, 'local_equity'), ('EM', 0, 'swap_2y'), ('EM', 1, 'local_equity'),
            ('CHN', 0, 'swap_2y'), ('CHN', 1, 'local_equity')) AS q(u, place, role)
  WHERE u = universe AND base IS NOT NULL AND (universe = 'G10' OR usd.leg IS NOT NULL)
  UNION ALL SELECT series_code, universe, 4, leg, 'cds_5y',
         CASE leg WHEN 'base' THEN base ELSE quote END
  FROM usd WHERE universe IN ('EM', 'CHN') AND leg IS NOT NULL),
resolved AS (
  SELECT n.*, role_code, CASE WHEN role_code IS NULL
           THEN 'No ' || n.role || ' series for ' || n.currency || '.' END AS reason
  FROM needs n LEFT JOIN roles r ON n.role = r.role AND n.currency = r.currency),
early AS (
  SELECT series_code, universe, -1 AS place, NULL AS leg, NULL AS role, NULL AS currency,
         NULL AS role_code,
         CASE WHEN base IS NULL THEN 'Could not parse currency legs from series_code ''' || series_code || '''.'
              ELSE '{discovery.NO_USD_LEG.replace("'", "''")}' END AS reason
  FROM usd WHERE base IS NULL OR (universe IN ('EM', 'CHN') AND leg IS NULL)),
allroles AS (SELECT * FROM resolved UNION ALL SELECT * FROM early)"""
REPORT = (
    """report AS (SELECT a.series_code, a.universe, any_value(base) AS base_currency,
  any_value(quote) AS quote_currency, count(reason) > 0 AS blocked,
  coalesce(string_agg(reason, '; ' ORDER BY place), '') AS block_reasons, """
    + ", ".join(
        f"max(CASE WHEN leg = '{leg}' AND role = '{role}' THEN role_code END) AS {leg}_{role}"
        for leg in discovery.LEGS
        for role in discovery.ROLES
    )
    + """ FROM allroles a JOIN fxpairs p ON a.series_code = p.series_code
  AND a.universe = p.universe GROUP BY 1, 2)"""
)
REPORT_VIEWS = (FX_CATALOG, ROLES, FX_PAIRS, NEEDS, REPORT)


def _world(spark, folder):
    return t.fx_catalog(spark, folder), t.fx_values(spark, folder)


def _report(spark, folder):
    catalog = t.fx_catalog(spark, folder)
    return discovery.availability_report(discovery.discover_pairs(catalog), catalog)


@query("fx_catalog", views(FX_CATALOG) + "SELECT * FROM fxcat")
def fx_catalog(spark, folder):
    return t.fx_catalog(spark, folder)


@query(
    "fx_values",
    views(FX_VALUES)
    + """SELECT series_code, d AS "timestamp", round(v, 6) + 0 AS "value" FROM fxval""",
)
def fx_values(spark, folder):
    return t.fx_values(spark, folder).withColumn("value", rounded("value"))


@query(
    "fx_legs",
    views(FX_CATALOG)
    + """, legs AS (SELECT series_code,
       nullif(regexp_extract(series_code, '^([A-Z]{3})([A-Z]{3})_', 1), '') AS base,
       nullif(regexp_extract(series_code, '^([A-Z]{3})([A-Z]{3})_', 2), '') AS quote FROM fxcat)
    SELECT series_code, base, quote, CASE WHEN base = 'USD' AND quote <> 'USD' THEN 'quote'
       WHEN quote = 'USD' AND base <> 'USD' THEN 'base' END AS leg FROM legs""",
)
def fx_legs(spark, folder):
    code = F.col(SERIES_CODE)
    return t.fx_catalog(spark, folder).select(
        SERIES_CODE,
        base_currency(code).alias("base"),
        quote_currency(code).alias("quote"),
        non_usd_leg(base_currency(code), quote_currency(code)).alias("leg"),
    )


@query("role_resolution", views(FX_CATALOG, ROLES) + "SELECT * FROM roles")
def role_resolution(spark, folder):
    return discovery.role_index(t.fx_catalog(spark, folder))


@query("availability_report", views(*REPORT_VIEWS) + "SELECT * FROM report")
def availability_report(spark, folder):
    return _report(spark, folder)


@query(
    "availability_roles",
    views(*REPORT_VIEWS)
    + "SELECT series_code, universe, leg, role, role_code FROM resolved WHERE role_code IS NOT NULL",
)
def availability_roles(spark, folder):
    return discovery.report_roles(_report(spark, folder))


@query(
    "blocked_summary",
    views(*REPORT_VIEWS)
    + "SELECT universe, count(*) FILTER (blocked) AS blocked, count(*) AS pairs FROM report GROUP BY 1",
)
def blocked_summary(spark, folder):
    return discovery.blocked_summary(_report(spark, folder))


MAPPING = """mapping AS (
  SELECT series_code, universe, 'rate' AS slot, series_code AS source_code FROM report WHERE NOT blocked
  UNION ALL SELECT series_code, universe, 'world_equity', 'MXWO_PX_LAST' FROM report WHERE NOT blocked
  UNION ALL SELECT series_code, universe, 'oil', 'BRENT_PX_LAST' FROM report WHERE NOT blocked
  UNION ALL SELECT series_code, universe, leg || CASE role WHEN 'swap_2y' THEN '_swap'
      WHEN 'rate_3m' THEN '_3m' WHEN 'yield_10y' THEN '_10y' ELSE '_equity' END, role_code
    FROM resolved JOIN report USING (series_code, universe)
    WHERE NOT blocked AND (role = 'swap_2y' OR universe = 'G10')
  UNION ALL SELECT series_code, universe, CASE role WHEN 'cds_5y' THEN 'cds' ELSE 'equity' END,
      role_code FROM resolved r JOIN usd USING (series_code, universe)
      JOIN report USING (series_code, universe)
    WHERE NOT blocked AND universe <> 'G10' AND role IN ('cds_5y', 'local_equity') AND r.leg = usd.leg
  UNION ALL SELECT series_code, universe, s, c FROM report, (VALUES
      ('offshore', 'OFFSHORE_SPREAD_PX_LAST'), ('onshore', 'ONSHORE_SPREAD_PX_LAST'), """ + ", ".join(
    f"('{slot}', '{code}')" for slot, code in drivers.FLOWS.items()
) + """) AS v(s, c) WHERE NOT blocked AND universe = 'CHN')"""


def _mapping(spark, folder):
    return drivers.series_mapping(_report(spark, folder).filter("NOT blocked"))


@query("series_mapping", views(*REPORT_VIEWS, MAPPING) + "SELECT * FROM mapping")
def series_mapping(spark, folder):
    return _mapping(spark, folder)


@query(
    "required_series",
    views(*REPORT_VIEWS, MAPPING) + "SELECT DISTINCT source_code AS series_code FROM mapping",
)
def required_series(spark, folder):
    return drivers.required_series(_mapping(spark, folder))


@query(
    "flows_cutover",
    views(FX_CATALOG)
    + """SELECT DISTINCT valid_to AS cutover FROM fxcat WHERE valid_to IS NOT NULL
    AND series_code LIKE '%FLOWS_PX_LAST'""",
)
def flows_cutover(spark, folder):
    catalog = t.fx_catalog(spark, folder)
    cutover = drivers.flows_cutover(catalog)
    return catalog.filter(F.col("valid_to").isNotNull()).select(
        F.lit(str(cutover)).alias("cutover")
    ).distinct()


CUTOVER = date.fromisoformat(t.FLOWS_END)
RAW = f"""slots AS (
  SELECT m.series_code, universe, d, {", ".join(
      f"max(CASE WHEN slot = '{s}' THEN v END) AS {s}" for s in drivers.SLOTS)}
  FROM mapping m JOIN fxval f ON m.source_code = f.series_code GROUP BY 1, 2, 3),
raw AS (
  SELECT series_code, universe, d, rate, base_swap - quote_swap AS interest_rate_differential,
    CASE WHEN universe = 'G10' THEN (base_3m - base_10y) - (quote_3m - quote_10y) ELSE cds END
      AS yield_curve_or_cds,
    CASE WHEN universe = 'G10' THEN ln(base_equity) - ln(quote_equity) ELSE ln(equity) END
      AS local_equity,
    ln(world_equity) AS global_equity, ln(oil) AS commodity,
    CASE WHEN universe = 'CHN' THEN offshore - onshore END AS offshore_spread,
    CASE WHEN universe = 'CHN' THEN CASE WHEN d < '{t.FLOWS_END}'
      THEN (shanghai_buy + shenzhen_buy) - (shanghai_sell + shenzhen_sell)
      ELSE shanghai_turnover + shenzhen_turnover END END AS flows
  FROM slots)"""
COLUMNS = ["rate", *FX_CHN.drivers]
FEATURES = f"""span AS (
  SELECT series_code, universe, min(d) AS lo, max(d) AS hi FROM raw WHERE rate IS NOT NULL GROUP BY 1, 2),
days AS (
  SELECT * FROM (SELECT series_code, universe,
    unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM span) WHERE isodow(d) <= 5),
silver AS (
  SELECT days.series_code, days.universe, days.d, {", ".join(
      f"last_value({c} IGNORE NULLS) OVER g AS {c}" for c in COLUMNS)}
  FROM days LEFT JOIN raw ON days.series_code = raw.series_code AND days.universe = raw.universe
    AND days.d = raw.d
  WINDOW g AS (PARTITION BY days.series_code, days.universe ORDER BY days.d
    ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
levels AS (SELECT *, last_value(rate IGNORE NULLS) OVER (PARTITION BY series_code, universe
    ORDER BY d ROWS UNBOUNDED PRECEDING) AS lv FROM silver),
moves AS (SELECT *, abs(lv / lag(lv) OVER (PARTITION BY series_code, universe ORDER BY d) - 1) AS mv
  FROM levels),
vols AS (SELECT *, CASE WHEN count(mv) OVER w = 20 THEN avg(mv) OVER w END AS realized_volatility
  FROM moves WINDOW w AS (PARTITION BY series_code, universe ORDER BY d
    ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
features AS (SELECT *, coalesce(realized_volatility >
    CASE universe WHEN 'G10' THEN 0.01 ELSE 0.0025 END, false) AS is_logged FROM vols)"""
FEATURE_VIEWS = (*REPORT_VIEWS, FX_VALUES, MAPPING, RAW, FEATURES)


def _raw(spark, folder):
    return drivers.raw_driver_frame(
        t.fx_values(spark, folder), _mapping(spark, folder), cutover=CUTOVER
    )


def _features(spark, folder):
    return drivers.build_features(drivers.conform_drivers(_raw(spark, folder)))


def _shown(frame):
    numbers = [c for c in (*COLUMNS, "realized_volatility") if c in frame.columns]
    flags = [c for c in ("is_logged",) if c in frame.columns]
    return frame.select(
        SERIES_CODE,
        "universe",
        F.col("day").cast("timestamp_ntz").alias("day"),
        *[rounded(c).alias(c) for c in numbers],
        *flags,
    )


def _shown_sql(table, extra=""):
    cells = ", ".join(f"round({c}, 6) + 0 AS {c}" for c in COLUMNS)
    return f'SELECT series_code, universe, d::TIMESTAMP AS "day", {cells}{extra} FROM {table}'


@query("driver_raw", views(*REPORT_VIEWS, FX_VALUES, MAPPING, RAW) + _shown_sql("raw"))
def driver_raw(spark, folder):
    """Driver formulas per day, both flow regimes included."""
    return _shown(_raw(spark, folder))


@query(
    "driver_features",
    views(*FEATURE_VIEWS)
    + _shown_sql("features", ", round(realized_volatility, 6) + 0 AS realized_volatility, is_logged"),
)
def driver_features(spark, folder):
    return _shown(_features(spark, folder))


AS_OF = "2001-11-05"


@query(
    "silver_frame",
    views(*FEATURE_VIEWS)
    + _shown_sql("silver")
    + f""" WHERE series_code IN (SELECT series_code FROM raw WHERE rate IS NOT NULL GROUP BY 1
      HAVING date_diff('day', max(d), DATE '{AS_OF}') <= 3)""",
)
def silver_frame(spark, folder):
    rows = drivers.silver_frame(
        t.fx_values(spark, folder), _report(spark, folder), as_of=AS_OF, cutover=CUTOVER
    )
    return _shown(rows)


@query(
    "stale_pairs",
    views(*REPORT_VIEWS, FX_VALUES, MAPPING, RAW)
    + """SELECT series_code, max(d) FILTER (rate IS NOT NULL)::TIMESTAMP AS latest FROM raw GROUP BY 1
    HAVING coalesce(date_diff('day', max(d) FILTER (rate IS NOT NULL), DATE '2001-11-06') > 3, true)""",
)
def stale_pairs(spark, folder):
    rows = drivers.stale_pairs(_raw(spark, folder), F.lit("2001-11-06").cast("timestamp_ntz"))
    return rows.select(SERIES_CODE, F.col("latest").cast("timestamp_ntz").alias("latest"))


@query(
    "feature_summary",
    views(*FEATURE_VIEWS)
    + """SELECT universe, count(DISTINCT series_code) AS pairs, count(*) AS "rows",
       round(avg(is_logged::INT), 6) AS logged_share FROM features GROUP BY 1""",
)
def feature_summary(spark, folder):
    rows = drivers.feature_summary(_features(spark, folder))
    return rows.withColumn("logged_share", rounded("logged_share"))


@query(
    "feature_checks",
    views(*FEATURE_VIEWS)
    + """SELECT series_code, count(*) FILTER (rate IS NULL OR rate < 1e-4 OR rate > 1e5) > 0
       AS bad_rate, count(*) FILTER (realized_volatility > 1) > 0 AS bad_volatility
    FROM features GROUP BY 1
    HAVING count(*) FILTER (rate IS NULL OR rate < 1e-4 OR rate > 1e5 OR realized_volatility > 1) > 0""",
)
def feature_checks(spark, folder):
    rows = failing_keys(_features(spark, folder), [SERIES_CODE], drivers.feature_rules())
    names = F.col("failed_checks")
    return rows.select(
        SERIES_CODE,
        F.array_contains(names, "rate out of range").alias("bad_rate"),
        F.array_contains(names, "realized_volatility out of range").alias("bad_volatility"),
    )


@query(
    "feature_gate",
    views(*FEATURE_VIEWS)
    + """SELECT universe, count(*) AS n FROM features WHERE series_code NOT IN (
      SELECT series_code FROM features WHERE rate IS NULL OR rate < 1e-4 OR rate > 1e5
        OR realized_volatility > 1) GROUP BY 1""",
)
def feature_gate(spark, folder):
    kept = drop_failing(_features(spark, folder), [SERIES_CODE], drivers.feature_rules())
    return kept.groupBy("universe").agg(F.count("*").alias("n"))


@query(
    "feature_gate_months",
    views(*FEATURE_VIEWS)
    + """SELECT universe, date_trunc('month', d)::TIMESTAMP AS "month", count(DISTINCT series_code) AS pairs, count(*) AS n
    FROM features WHERE (series_code, date_trunc('month', d)) NOT IN (
      SELECT (series_code, date_trunc('month', d)) FROM features WHERE rate IS NULL OR rate < 1e-4 OR rate > 1e5
        OR realized_volatility > 1) GROUP BY 1, 2""",
)
def feature_gate_months(spark, folder):
    """The gate by pair and month: a month with one bad day is left out whole."""
    rows = _features(spark, folder).withColumn("month", F.date_trunc("month", "day").cast("timestamp_ntz"))
    kept = drop_failing(rows, [SERIES_CODE, "month"], drivers.feature_rules())
    return kept.groupBy("universe", "month").agg(
        F.count_distinct(SERIES_CODE).alias("pairs"), F.count("*").alias("n")
    )


# -- regression ----------------------------------------------------------------------------

X1, X2 = "interest_rate_differential", "global_equity"
KEYS = [SERIES_CODE, "universe"]


@query(
    "ols_moments",
    views(*FEATURE_VIEWS)
    + f"""SELECT series_code, universe, count(*) AS n, round(avg(rate), 6) + 0 AS mean_y,
       round(avg({X1}), 6) + 0 AS mean_x, round(covar_pop(rate, {X1}), 6) + 0 AS cov_yx,
       round(covar_pop({X1}, {X1}), 6) + 0 AS cov_xx, round(covar_pop(rate, rate), 6) + 0 AS cov_yy
    FROM features WHERE rate IS NOT NULL AND {X1} IS NOT NULL GROUP BY 1, 2""",
)
def ols_moments(spark, folder):
    rows = estimation.moments(_features(spark, folder), KEYS, "rate", [X1])
    return rows.select(
        *KEYS,
        "n",
        rounded("mean_rate").alias("mean_y"),
        rounded(f"mean_{X1}").alias("mean_x"),
        rounded(f"cov_rate_{X1}").alias("cov_yx"),
        rounded(f"cov_{X1}_{X1}").alias("cov_xx"),
        rounded("cov_rate_rate").alias("cov_yy"),
    )


@query(
    "ols_bivariate",
    views(*FEATURE_VIEWS)
    + f"""SELECT series_code, universe, regr_count(rate, {X1})::BIGINT AS n,
       round(regr_slope(rate, {X1}), 6) + 0 AS slope,
       round(regr_intercept(rate, {X1}), 6) + 0 AS intercept,
       round(regr_r2(rate, {X1}), 6) + 0 AS r_squared
    FROM features GROUP BY 1, 2 HAVING regr_count(rate, {X1}) >= 60""",
)
def ols_bivariate(spark, folder):
    rows = estimation.moments(_features(spark, folder), KEYS, "rate", [X1])
    solved = estimation.solve_moments(rows, "rate", [X1], min_observations=60)
    return solved.select(
        *KEYS,
        "n",
        rounded(f"coefficient_{X1}").alias("slope"),
        rounded("coefficient_const").alias("intercept"),
        rounded("r_squared").alias("r_squared"),
    )


@query(
    "ols_two_driver",
    views(*FEATURE_VIEWS)
    + f""", s AS (SELECT series_code, universe, count(*) AS n, avg(rate) AS my, avg({X1}) AS m1,
        avg({X2}) AS m2, covar_pop({X1}, {X1}) AS s11, covar_pop({X1}, {X2}) AS s12,
        covar_pop({X2}, {X2}) AS s22, covar_pop({X1}, rate) AS s1y, covar_pop({X2}, rate) AS s2y,
        covar_pop(rate, rate) AS syy
      FROM features WHERE rate IS NOT NULL AND {X1} IS NOT NULL AND {X2} IS NOT NULL GROUP BY 1, 2),
    b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
        (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM s WHERE n >= 60)
    SELECT series_code, universe, n, round(b1, 6) + 0 AS b1, round(b2, 6) + 0 AS b2,
       round(my - b1 * m1 - b2 * m2, 6) + 0 AS b0,
       round(sqrt(syy - b1 * s1y - b2 * s2y), 6) + 0 AS residual_std FROM b""",
)
def ols_two_driver(spark, folder):
    rows = estimation.moments(_features(spark, folder), KEYS, "rate", [X1, X2])
    solved = estimation.solve_moments(rows, "rate", [X1, X2], min_observations=60)
    return solved.select(
        *KEYS,
        "n",
        rounded(f"coefficient_{X1}").alias("b1"),
        rounded(f"coefficient_{X2}").alias("b2"),
        rounded("coefficient_const").alias("b0"),
        rounded("residual_std").alias("residual_std"),
    )


@query(
    "ols_rolling",
    views(*FEATURE_VIEWS)
    + f""", f AS (SELECT series_code, universe, d, rate AS y, {X1} AS x FROM features
      WHERE rate IS NOT NULL AND {X1} IS NOT NULL)
    SELECT a.series_code, a.universe, a.d::TIMESTAMP AS "day", count(*) AS n,
       round(regr_slope(b.y, b.x), 6) + 0 AS slope,
       round(regr_intercept(b.y, b.x), 6) + 0 AS intercept
    FROM f a JOIN f b ON a.series_code = b.series_code AND a.universe = b.universe
      AND b.d <= a.d AND b.d > a.d - INTERVAL 6 MONTH
    GROUP BY 1, 2, 3 HAVING count(*) >= 60""",
)
def ols_rolling(spark, folder):
    """A regression at every date of every pair, from one windowed pass."""
    rows = estimation.rolling_moments(_features(spark, folder), KEYS, "rate", [X1], 6)
    solved = estimation.solve_moments(rows, "rate", [X1], min_observations=60)
    return solved.select(
        *KEYS,
        F.col("day").cast("timestamp_ntz").alias("day"),
        "n",
        rounded(f"coefficient_{X1}").alias("slope"),
        rounded("coefficient_const").alias("intercept"),
    )


def _every_universe(run):
    """Rows of all universes; a driver that a universe does not have is NULL."""
    return reduce(lambda left, right: left.unionByName(right, True), map(run, UNIVERSES.values()))


def _figures(frame, digits=5):
    """Numbers of a result table to a few digits: scores and p-values by places, others by size."""
    places = ("z_score", "entry_z_score", "residual", "cointegration_p_value", "p_value")
    return frame.select(
        *[
            (
                F.col(f.name)
                if f.dataType.simpleString() != "double"
                else rounded(f.name, digits)
                if f.name in places or f.name.startswith("p_value_")
                else figure(f.name, digits)
            ).alias(f.name)
            for f in frame.schema
        ]
    )


def _written_features(spark, folder):
    return cut_lineage(_features(spark, folder), "features")


def _fits_sql(days, *parts):
    return fits.with_views(*FEATURE_VIEWS, days, *fits.FITS, *parts)


EACH_TEST = (fits.EACH_TESTED, fits.RESIDUALS, *fits.TESTS)
NEWEST_TEST = (fits.NEWEST_TESTED, fits.RESIDUALS, *fits.TESTS)
MODEL_DAY = "2001-06-29"


@query("ols_multi", _fits_sql(fits.LAST_DAYS, *EACH_TEST) + fits.estimate_sql())
def ols_multi(spark, folder):
    """Five- and seven-driver fits with sign check and unit-root test at each pair's newest day."""
    features = _written_features(spark, folder)
    return _figures(estimation.estimate(features, UNIVERSES))


MONTH_ENDS = """fitdays AS (
  SELECT series_code, universe, as_of FROM (SELECT DISTINCT series_code, universe FROM features),
    (SELECT DISTINCT last_day(d) AS as_of FROM features))"""


def _month_ends(features):
    """Calendar month ends, of which a century has 1,200."""
    ends = features.select(F.last_day(F.col("day").cast("date")).alias("d")).distinct().collect()
    return sorted(row["d"] for row in ends)


@query("ols_sign_refit", _fits_sql(MONTH_ENDS) + fits.estimate_sql(digits=4, tested=False))
def ols_sign_refit(spark, folder):
    """Fits with sign check and refit of every pair at every month's end."""
    features = _written_features(spark, folder)
    solved = estimation.estimate(features, UNIVERSES, fit_dates=_month_ends(features), test_dates=[])
    return _without_tests(_figures(solved, 4))


def _without_tests(frame):
    return frame.drop(*[c for c in frame.columns if c.startswith(("cointegration_", "critical_"))])


@query(
    "cointegration_latest",
    _fits_sql(MONTH_ENDS, *EACH_TEST)
    + f"""SELECT o.series_code, o.universe, o.as_of::DATE AS as_of, o.n AS cointegration_n_obs,
       coalesce(p <= significance, false) AS cointegration_passed, round(p, 4) + 0 AS cointegration_p_value,
       {fits.figure("statistic", 4)} AS cointegration_statistic, {fits.critical_columns(4)}
    FROM one o JOIN par USING (universe) LEFT JOIN tests USING (series_code, universe, as_of)""",
)
def cointegration_latest(spark, folder):
    """The unit-root test of each pair's residuals with its newest window, at every month's end."""
    features = _written_features(spark, folder)
    tests = estimation.estimate(features, UNIVERSES, fit_dates=_month_ends(features))
    shown = [c for c in tests.columns if c.startswith(("cointegration_", "critical_"))]
    return _figures(tests.filter("cointegration_n_obs IS NOT NULL").select(*KEYS, "as_of", *shown), 4)


@query(
    "fair_value_fit",
    _fits_sql(fits.last_dates(5, MODEL_DAY), *EACH_TEST, fits.EACH_VERDICT, fits.FIRED) + fits.CROSS_SECTION,
)
def fair_value_fit(spark, folder):
    """Five fit dates, tested at each: the cross-section of all pairs."""
    catalog, values = _world(spark, folder)
    found = model.fit_universes(
        catalog, values, as_of=MODEL_DAY, lookback_days=5, cointegration=model.EACH
    )
    return _figures(_every_universe(lambda universe: found[universe.name].summary))


@query(
    "fair_value_rows",
    _fits_sql(fits.last_dates(1, MODEL_DAY)) + fits.WINDOW_ROWS,
)
def fair_value_rows(spark, folder):
    """Windowed fitted values and bands of all pairs."""
    catalog, values = _world(spark, folder)
    found = model.fit_universes(catalog, values, as_of=MODEL_DAY)
    return _figures(_every_universe(lambda universe: found[universe.name].rows()))


@query(
    "fair_value_signals",
    _fits_sql(fits.last_dates(3, MODEL_DAY), *NEWEST_TEST, fits.NEWEST_VERDICT, fits.FIRED) + fits.SIGNAL_ROWS,
)
def fair_value_signals(spark, folder):
    catalog, values = _world(spark, folder)
    found = model.fit_universes(catalog, values, as_of=MODEL_DAY, lookback_days=3)
    return _figures(_every_universe(lambda universe: results.signal_rows(found[universe.name].signals)))


@query("fair_value_history", _fits_sql(fits.EVERY_DAY) + fits.estimate_sql(digits=3, tested=False))
def fair_value_history(spark, folder):
    """Sign-checked fits of every pair at every day."""
    features = _written_features(spark, folder)
    solved = estimation.estimate(features, UNIVERSES, every_day=True, test_dates=[])
    return _without_tests(_figures(solved, 3))


@query("design_matrix", _fits_sql(fits.LAST_DAYS) + fits.DESIGN_ROWS)
def design_matrix(spark, folder):
    features = _written_features(spark, folder)
    solved = cut_lineage(estimation.estimate(features, UNIVERSES, test_dates=[]), "estimates")
    return _figures(
        _every_universe(
            lambda universe: estimation.design_rows(
                features, solved.filter(F.col("universe") == universe.name), universe
            )
        )
    )


@query(
    "cointegration_pairs",
    fits.with_views(*FEATURE_VIEWS, fits.PAIR_RESIDUALS, *fits.TESTS) + fits.PAIR_TESTS,
)
def cointegration_pairs(spark, folder):
    """Two-series cointegration of every rate with its local equity driver."""
    return _figures(
        estimation.pairwise_cointegration(
            _features(spark, folder), "rate", "local_equity", keys=KEYS, as_of=date(2001, 6, 29)
        )
    )


# -- signals and result tables over customer-shaped estimates ------------------------------

ESTIMATES = """est AS (
  SELECT 'C' || c_custkey AS series_code,
    CASE c_custkey % 3 WHEN 0 THEN 'G10' WHEN 1 THEN 'EM' ELSE 'CHN' END AS universe,
    o_orderdate AS as_of, o_orderkey AS _seq, o_orderkey % 4 = 0 AS is_logged,
    (c_acctbal - 4321.123) / 2203.7 AS z_score,
    CASE WHEN o_orderkey % 4 = 0 THEN ln(o_totalprice) ELSE o_totalprice END AS fitted_value,
    o_totalprice / 0.93 AS current_rate, o_orderkey % 100 < 60 AS cointegration_passed,
    (o_orderkey % 100) / 1000.0 AS cointegration_p_value,
    CASE WHEN o_orderkey % 5 = 0 THEN 'local_equity,commodity' ELSE '' END AS dropped_variables
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
SIGNALS = """sig AS (
  SELECT *, CASE WHEN NOT cointegration_passed OR abs(z_score) < 1.5 THEN 'NONE'
                 WHEN z_score > 0 THEN 'SELL' ELSE 'BUY' END AS signal FROM est),
tgt AS (SELECT *, CASE WHEN signal <> 'NONE' THEN CASE WHEN is_logged THEN exp(fitted_value)
    ELSE fitted_value END END AS target FROM sig),
stp AS (SELECT *, CASE signal WHEN 'SELL' THEN current_rate + abs(current_rate - target) / 2
    WHEN 'BUY' THEN current_rate - abs(current_rate - target) / 2 END AS stop_loss,
  CASE WHEN NOT cointegration_passed THEN 'cointegration failed (p='
         || printf('%.4f', cointegration_p_value) || ')'
       WHEN abs(z_score) < 1.5 THEN '|z|=' || printf('%.2f', abs(z_score)) || ' below threshold 1.5'
       ELSE '|z|=' || printf('%.2f', abs(z_score)) || ' >= threshold 1.5, cointegrated' END AS reason
  FROM tgt)"""


def _estimates(spark, folder):
    """One estimate per order and customer, shaped like the model's output."""
    key = F.col("o_orderkey")
    nation = F.col("c_custkey") % 3
    return (
        t.load(spark, folder, "orders")
        .join(t.load(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias(SERIES_CODE),
            F.when(nation == 0, "G10").when(nation == 1, "EM").otherwise("CHN").alias("universe"),
            F.col("o_orderdate").alias("as_of"),
            key.alias("_seq"),
            F.lit("ok").alias("status"),
            (key % 4 == 0).alias("is_logged"),
            ((F.col("c_acctbal") - 4321.123) / 2203.7).alias("z_score"),
            F.when(key % 4 == 0, F.ln("o_totalprice"))
            .otherwise(F.col("o_totalprice"))
            .alias("fitted_value"),
            (F.col("o_totalprice") / 0.93).alias("current_rate"),
            (key % 100 < 60).alias("cointegration_passed"),
            ((key % 100) / 1000.0).alias("cointegration_p_value"),
            F.when(key % 5 == 0, "local_equity,commodity").otherwise("").alias("dropped_variables"),
        )
    )


def _fired(spark, folder):
    return signals.with_signals(_estimates(spark, folder), z_threshold=1.5, stop_reward_ratio=2.0)


@query(
    "signals",
    views(ESTIMATES, SIGNALS)
    + """SELECT as_of AS "date", universe, series_code, signal, round(z_score, 6) + 0
       AS entry_z_score, round(target, 4) AS target, round(stop_loss, 4) AS stop_loss, reason
    FROM stp""",
)
def signal_rows(spark, folder):
    rows = results.signal_rows(_fired(spark, folder))
    return rows.select(
        "date", "universe", SERIES_CODE, "signal", rounded("entry_z_score").alias("entry_z_score"),
        F.round("target", 4).alias("target"), F.round("stop_loss", 4).alias("stop_loss"), "reason",
    )


@query(
    "signal_counts",
    views(ESTIMATES, SIGNALS) + "SELECT signal, count(*) AS n FROM stp GROUP BY 1",
)
def signal_counts(spark, folder):
    return signals.signal_counts(results.signal_rows(_fired(spark, folder)))


@query(
    "latest_per_pair",
    views(ESTIMATES)
    + """SELECT series_code, arg_max(as_of, (as_of, _seq)) AS as_of,
       round(arg_max(fitted_value, (as_of, _seq)), 4) AS fitted_value FROM est GROUP BY 1""",
)
def latest_per_pair(spark, folder):
    rows = results.latest_per_pair(
        _estimates(spark, folder).select(SERIES_CODE, "as_of", "_seq", "fitted_value")
    )
    return rows.select(SERIES_CODE, "as_of", F.round("fitted_value", 4).alias("fitted_value"))


@query(
    "panel_z",
    """SELECT as_of, """
    + ", ".join(
        f"round(max(CASE WHEN series_code = '{p}' THEN z END), 6) + 0 AS \"{p}\""
        for p in t.PRIORITIES
    )
    + """ FROM (SELECT o_orderpriority AS series_code, o_orderdate AS as_of,
      max(o_totalprice) / 99991 AS z FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def panel_z(spark, folder):
    rows = (
        t.load(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias(SERIES_CODE), F.col("o_orderdate").alias("as_of"))
        .agg((F.max("o_totalprice") / 99991).alias("z_score"))
    )
    wide = results.panel(rows, "z_score", t.PRIORITIES)
    return wide.select("as_of", *[rounded(f"`{p}`").alias(p) for p in t.PRIORITIES])


@query(
    "z_scores",
    views(ESTIMATES)
    + """SELECT series_code, as_of, round(z_score, 6) + 0 AS z_score,
       CASE WHEN z_score >= 1.5 THEN 'high' WHEN z_score <= -1.5 THEN 'low' ELSE 'inside' END AS flag
    FROM est""",
)
def z_scores(spark, folder):
    rows = results.z_scores(_estimates(spark, folder), 1.5)
    return rows.select(SERIES_CODE, "as_of", rounded("z_score").alias("z_score"), "flag")


DAY = "DATE '1998-06-15'"


def _tables(spark, folder):
    fired = _fired(spark, folder)
    estimates = fired.select(
        F.col("as_of").alias("date"), "universe", SERIES_CODE, "cointegration_passed",
        (F.col("dropped_variables") != "").alias("sign_dropped"), "dropped_variables",
    )
    return estimates, results.signal_rows(fired)


@query(
    "digest",
    views(ESTIMATES, SIGNALS)
    + f"""SELECT count(*) FILTER (NOT cointegration_passed) AS cointegration_failures,
       count(*) FILTER (dropped_variables <> '') AS sign_drops,
       count(*) FILTER (signal <> 'NONE') AS new_signals FROM stp WHERE as_of = {DAY}""",
)
def digest(spark, folder):
    return results.digest(*_tables(spark, folder), F.expr(DAY))


@query(
    "digest_checks",
    views(ESTIMATES, SIGNALS)
    + f"""SELECT universe || '/' || series_code || ': cointegration' AS label,
       CASE WHEN cointegration_passed THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN NOT cointegration_passed THEN 'Engle-Granger test did not pass' END AS note
    FROM stp WHERE as_of = {DAY}
    UNION ALL SELECT universe || '/' || series_code || ': sign check', 'WARN',
       'Dropped variable(s) with the wrong sign: ' || dropped_variables
    FROM stp WHERE as_of = {DAY} AND dropped_variables <> ''""",
)
def digest_checks(spark, folder):
    return results.check_rows(_tables(spark, folder)[0], F.expr(DAY))


@query(
    "run_counters",
    views(ESTIMATES)
    + """SELECT universe, as_of AS "date", count(DISTINCT series_code) AS pairs,
       count(*) FILTER (cointegration_passed) AS passed,
       count(*) FILTER (dropped_variables <> '') AS sign_dropped FROM est GROUP BY 1, 2""",
)
def run_counters(spark, folder):
    return results.run_counters(_tables(spark, folder)[0])


@query(
    "dropped_names",
    views(ESTIMATES)
    + """SELECT name, count(*) AS n FROM (SELECT unnest(string_split(dropped_variables, ',')) AS name
      FROM est WHERE dropped_variables <> '') GROUP BY 1""",
)
def dropped_names(spark, folder):
    rows = _estimates(spark, folder).select(
        F.explode(split_names(F.col("dropped_variables"))).alias("name")
    )
    return rows.groupBy("name").agg(F.count("*").alias("n"))


