"""Chart-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from serieslake.operators import charts
from serieslake.operators.values import last_value, last_wins
from serieslake.registry import tables as t
from serieslake.registry.base import (
    PANEL,
    SPARSE,
    TICKS,
    last_wins_sql,
    query,
    rounded,
    views,
)
from serieslake.registry.calendar import MONTHS, TENORS, tenor_text
from serieslake.schema import SERIES_CODE, TIMESTAMP, VALUE


@query(
    "ohlc_weekly",
    views(TICKS, last_wins_sql("ticks"))
    + """SELECT series_code, date_trunc('week', "timestamp")::TIMESTAMP + INTERVAL 6 DAY AS period,
       arg_min("value", "timestamp") AS "open", max("value") AS high, min("value") AS low,
       arg_max("value", "timestamp") AS "close" FROM ticks_last GROUP BY 1, 2""",
)
def ohlc_weekly(spark, folder):
    return charts.ohlc(last_wins(t.ticks(spark, folder)), "W")


@query(
    "seasonality_month",
    views(SPARSE, last_wins_sql("sparse"))
    + """SELECT series_code, year("timestamp") AS "year", month("timestamp") - 1 AS slot,
       round(avg("value") / 1.03, 4) + 0 AS mean FROM sparse_last GROUP BY 1, 2, 3""",
)
def seasonality_month(spark, folder):
    return _season(spark, folder, "month")


@query(
    "seasonality_dow",
    views(SPARSE, last_wins_sql("sparse"))
    + """SELECT series_code, year("timestamp") AS "year", isodow("timestamp") - 1 AS slot,
       round(avg("value") / 1.03, 4) + 0 AS mean FROM sparse_last GROUP BY 1, 2, 3""",
)
def seasonality_dow(spark, folder):
    return _season(spark, folder, "dayofweek")


def _season(spark, folder, period):
    rows = charts.seasonality(last_wins(t.sparse(spark, folder)), period)
    return rows.select(
        SERIES_CODE, F.col("year").cast("bigint").alias("year"),
        F.col("slot").cast("bigint").alias("slot"), rounded(F.col("mean") / 1.03, 4).alias("mean"),
    )


PAIRS = """pairs AS (
  SELECT a.series_code AS series_x, b.series_code AS series_y, a."value" AS x, b."value" AS y
  FROM panel a JOIN panel b ON a."timestamp" = b."timestamp")"""


@query(
    "corr_matrix",
    views(PANEL, PAIRS)
    + "SELECT series_x, series_y, round(corr(x, y), 4) + 0 AS correlation FROM pairs GROUP BY 1, 2",
)
def corr_matrix(spark, folder):
    rows = charts.correlation_matrix(t.panel(spark, folder), t.PANEL_CODES)
    return rows.withColumn("correlation", rounded("correlation", 4))


@query(
    "corr_spearman",
    views(PANEL, PAIRS)
    + """, ranked AS (SELECT series_x, series_y,
      rank() OVER (PARTITION BY series_x, series_y ORDER BY x)
        + (count(*) OVER (PARTITION BY series_x, series_y, x) - 1) / 2.0 AS rx,
      rank() OVER (PARTITION BY series_x, series_y ORDER BY y)
        + (count(*) OVER (PARTITION BY series_x, series_y, y) - 1) / 2.0 AS ry FROM pairs)
    SELECT series_x, series_y, round(corr(rx, ry), 4) + 0 AS correlation FROM ranked GROUP BY 1, 2""",
)
def corr_spearman(spark, folder):
    rows = charts.correlation_matrix(t.panel(spark, folder), t.PANEL_CODES, "spearman")
    return rows.withColumn("correlation", rounded("correlation", 4))


@query(
    "corr_kendall",
    views(PANEL)
    + """, pairs AS (SELECT a.series_code AS series_x, b.series_code AS series_y, a."timestamp" AS ts,
      a."value" AS x, b."value" AS y FROM panel a JOIN panel b ON a."timestamp" = b."timestamp"),
    c AS (SELECT p.series_x, p.series_y, sign(p.x - q.x)::BIGINT AS sx, sign(p.y - q.y)::BIGINT AS sy
      FROM pairs p JOIN pairs q
        ON p.series_x = q.series_x AND p.series_y = q.series_y AND p.ts < q.ts)
    SELECT series_x, series_y, round(sum(sx * sy)::DOUBLE
       / sqrt(sum(abs(sx))::DOUBLE * sum(abs(sy))::DOUBLE), 4) + 0 AS correlation
    FROM c GROUP BY 1, 2""",
)
def corr_kendall(spark, folder):
    rows = charts.correlation_matrix(t.panel(spark, folder), t.PANEL_CODES, "kendall")
    return rows.withColumn("correlation", rounded("correlation", 4))


@query(
    "histogram",
    views(TICKS)
    + """, lim AS (SELECT series_code, min("value") AS lo, max("value") AS hi FROM ticks GROUP BY 1),
    counts AS (SELECT t.series_code, least(floor(("value" - lo) / ((hi - lo) / 20)), 19)::INT AS bin,
        count(*) AS n FROM ticks t JOIN lim ON t.series_code = lim.series_code GROUP BY 1, 2),
    bins AS (SELECT series_code, lo, hi, unnest(range(20))::INT AS bin FROM lim)
    SELECT b.series_code, b.bin, round(lo + b.bin * ((hi - lo) / 20), 6) AS bin_low,
       round(CASE WHEN b.bin = 19 THEN hi ELSE lo + (b.bin + 1) * ((hi - lo) / 20) END, 6) AS bin_high,
       coalesce(n, 0) AS n
    FROM bins b LEFT JOIN counts c ON b.series_code = c.series_code AND b.bin = c.bin""",
)
def histogram(spark, folder):
    rows = charts.histogram(t.ticks(spark, folder), 20)
    return rows.select(
        SERIES_CODE, "bin", rounded("bin_low").alias("bin_low"),
        rounded("bin_high").alias("bin_high"), "n",
    )


@query(
    "boxplot",
    views(TICKS)
    + """SELECT series_code, min("value") AS low, round(quantile_cont("value", 0.25), 6) AS q1,
       round(quantile_cont("value", 0.5), 6) AS median, round(quantile_cont("value", 0.75), 6) AS q3,
       max("value") AS high FROM ticks GROUP BY 1""",
)
def boxplot(spark, folder):
    rows = charts.boxplot(t.ticks(spark, folder))
    return rows.select(
        SERIES_CODE, "low", *[rounded(c).alias(c) for c in ("q1", "median", "q3")], "high"
    )


@query(
    "calendar_values",
    views(SPARSE, last_wins_sql("sparse"))
    + """SELECT s.series_code, strftime("timestamp", '%Y-%m-%d') AS "day",
       round("value", 4) AS "value" FROM sparse_last s
    JOIN (SELECT series_code, max(year("timestamp")) AS y FROM sparse_last GROUP BY 1) m
      ON s.series_code = m.series_code AND year("timestamp") = y""",
)
def calendar_values(spark, folder):
    return charts.calendar_values(last_wins(t.sparse(spark, folder)))


@query(
    "scatter_pairs",
    views(PANEL)
    + """SELECT a."timestamp", round(a."value", 4) AS x, round(b."value", 4) AS y
    FROM panel a JOIN panel b ON a."timestamp" = b."timestamp"
    WHERE a.series_code = 'A_F' AND b.series_code = 'R_O'""",
)
def scatter_pairs(spark, folder):
    rows = charts.scatter_pairs(t.panel(spark, folder), "A_F", "R_O")
    return rows.select(TIMESTAMP, rounded("x", 4).alias("x"), rounded("y", 4).alias("y"))


TENOR_CATALOG = f"""tenors AS (
  SELECT 'C' || c_custkey AS series_code, {TENORS} AS tenor,
         round(({MONTHS})::DOUBLE, 6) AS months FROM customer WHERE c_custkey % 6 < 5),
vals AS (SELECT 'C' || o_custkey AS series_code, o_orderdate AS "timestamp",
         o_totalprice AS "value", o_orderkey AS _seq FROM orders)"""


def _tenors(spark, folder):
    """Customers with a tenor; one in six has none and is left out of curves."""
    return t.load(spark, folder, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias(SERIES_CODE),
        F.when(F.col("c_custkey") % 6 < 5, tenor_text()).alias("tenor"),
    )


@query(
    "yield_curve",
    views(TENOR_CATALOG)
    + """SELECT t.series_code, tenor, months, v."value" FROM tenors t JOIN (
      SELECT series_code, arg_max("value", ("timestamp", _seq)) AS "value" FROM vals GROUP BY 1) v
    ON t.series_code = v.series_code""",
)
def yield_curve(spark, folder):
    latest = last_value(t.values(spark, folder)).select(SERIES_CODE, VALUE)
    rows = charts.yield_curve(latest, _tenors(spark, folder))
    return rows.withColumn("months", F.round("months", 6))


DATES = ["1996-06-30", "1998-06-30", "2000-06-30"]


@query(
    "term_structure",
    views(TENOR_CATALOG, last_wins_sql("vals"))
    + """SELECT t.series_code, d.as_of, tenor, months,
       (SELECT arg_max("value", "timestamp") FROM vals_last v WHERE v.series_code = t.series_code
          AND v."timestamp" <= d.as_of::TIMESTAMP) AS "value"
    FROM tenors t, (VALUES ('1996-06-30'), ('1998-06-30'), ('2000-06-30')) AS d(as_of)
    WHERE t.series_code IN (SELECT series_code FROM vals)""",
)
def term_structure(spark, folder):
    rows = last_wins(t.values(spark, folder))
    curve = charts.term_structure(rows, _tenors(spark, folder), DATES)
    return curve.withColumn("months", F.round("months", 6))


@query(
    "seasonality_lines",
    views(PANEL)
    + """SELECT series_code, month("timestamp") - 1 AS slot,
       round(avg(CASE WHEN year("timestamp") = 1998 THEN "value" END), 4) + 0 AS y1998,
       round(avg(CASE WHEN year("timestamp") = 1999 THEN "value" END), 4) + 0 AS y1999
    FROM panel GROUP BY 1, 2""",
)
def seasonality_lines(spark, folder):
    rows = charts.seasonality_lines(t.panel(spark, folder), [1998, 1999])
    return rows.select(
        SERIES_CODE, F.col("slot").cast("bigint").alias("slot"),
        rounded("1998", 4).alias("y1998"), rounded("1999", 4).alias("y1999"),
    )
