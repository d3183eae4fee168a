"""Calendar, conforming, resampling and date-parsing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from serieslake.functions.dates import (
    age_days,
    floor_day,
    parse_timestamp,
    to_utc,
    truncate_precision,
)
from serieslake.functions.text import tenor_months
from serieslake.operators import periods
from serieslake.operators.rolling import realized_volatility
from serieslake.operators.values import last_wins
from serieslake.registry import tables as t
from serieslake.registry.base import (
    PANEL,
    SPARSE,
    TICKS,
    VALS,
    last_wins_sql,
    query,
    rounded,
    views,
)
from serieslake.schema import SERIES_CODE, TIMESTAMP, VALUE

# Business-day grid of the sparse panel with gaps of up to three days filled.
GRID = """bounds AS (
  SELECT series_code, min("timestamp") AS lo, max("timestamp") AS hi FROM sparse_last GROUP BY 1),
grid AS (
  SELECT series_code, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS "timestamp" FROM bounds),
weekdays AS (SELECT * FROM grid WHERE isodow("timestamp") <= 5),
conformed AS (
  SELECT w.series_code, w."timestamp",
         last_value("value" IGNORE NULLS) OVER (PARTITION BY w.series_code ORDER BY w."timestamp"
           ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS "value"
  FROM weekdays w LEFT JOIN sparse_last s
    ON w.series_code = s.series_code AND w."timestamp" = s."timestamp")"""


def _rare(spark, folder):
    """All orders by group of customers: days without data, repeats within a day."""
    group = F.concat(F.lit("G"), (F.col("o_custkey") % 50).cast("string"))
    return t.load(spark, folder, "orders").select(
        group.alias(SERIES_CODE),
        F.col("o_orderdate").cast("timestamp_ntz").alias(TIMESTAMP),
        F.col("o_totalprice").alias(VALUE),
        F.col("o_orderkey").alias("_seq"),
    )


RARE = SPARSE.replace("o_orderpriority AS series_code", "'G' || (o_custkey % 50) AS series_code")


@query(
    "business_days",
    views(RARE, last_wins_sql("sparse"), GRID)
    + """SELECT series_code, "timestamp" AS "day" FROM weekdays""",
)
def business_days(spark, folder):
    return periods.business_days(_rare(spark, folder))


@query(
    "conform_ffill",
    views(RARE, last_wins_sql("sparse"), GRID) + "SELECT * FROM conformed",
)
def conform_ffill(spark, folder):
    return periods.conform_series(_rare(spark, folder))


@query(
    "realized_vol",
    views(RARE, last_wins_sql("sparse"), GRID)
    + """, padded AS (SELECT *, last_value("value" IGNORE NULLS) OVER (PARTITION BY series_code
          ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS level FROM conformed),
    moved AS (SELECT *, abs(level / lag(level) OVER (PARTITION BY series_code
          ORDER BY "timestamp") - 1) AS move FROM padded),
    means AS (SELECT series_code, "timestamp", avg(move) OVER w AS v, count(move) OVER w AS n
      FROM moved WINDOW w AS (PARTITION BY series_code ORDER BY "timestamp"
        ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
    SELECT series_code, "timestamp", CASE WHEN n = 20 THEN round(v, 6) + 0 END
      AS realized_volatility FROM means""",
)
def realized_vol(spark, folder):
    rows = realized_volatility(periods.conform_series(_rare(spark, folder)))
    return rows.select(
        SERIES_CODE, TIMESTAMP, rounded("realized_volatility").alias("realized_volatility")
    )


@query(
    "resample_last",
    views(TICKS)
    + """SELECT series_code, date_trunc('week', "timestamp")::TIMESTAMP + INTERVAL 6 DAY AS period,
       arg_max("value", ("timestamp", _seq)) AS "value" FROM ticks GROUP BY 1, 2""",
)
def resample_last(spark, folder):
    return periods.resample_last(t.ticks(spark, folder), "W")


@query(
    "resample_month_end",
    views(VALS)
    + """SELECT series_code, last_day("timestamp")::TIMESTAMP AS period,
       arg_max("value", ("timestamp", _seq)) AS "value" FROM vals GROUP BY 1, 2""",
)
def resample_month_end(spark, folder):
    return periods.resample_last(t.values(spark, folder), "M")


@query(
    "month_window",
    views(PANEL)
    + """SELECT series_code, "timestamp", round("value", 4) + 0 AS "value" FROM panel
    WHERE "timestamp" > TIMESTAMP '2000-05-31' - INTERVAL 3 MONTH
      AND "timestamp" <= '2000-05-31'""",
)
def month_window(spark, folder):
    rows = periods.month_window(t.panel(spark, folder), "2000-05-31", 3)
    return rows.withColumn(VALUE, rounded(VALUE, 4))


@query(
    "year_months",
    views(VALS)
    + """SELECT series_code, year(m) AS "year", month(m) AS "month" FROM (
      SELECT series_code, unnest(generate_series(date_trunc('month', min("timestamp"))::TIMESTAMP,
        max("timestamp"), INTERVAL 1 MONTH)) AS m FROM vals GROUP BY 1)""",
)
def year_months(spark, folder):
    rows = periods.year_months(t.values(spark, folder))
    return rows.select(
        SERIES_CODE, F.col("year").cast("bigint").alias("year"),
        F.col("month").cast("bigint").alias("month"),
    )


@query(
    "dates_by_month",
    """SELECT year(d) AS "year", month(d) AS "month", count(*) AS n,
       string_agg(strftime(d, '%d'), ',' ORDER BY d) AS days
    FROM (SELECT DISTINCT l_shipdate AS d FROM lineitem) GROUP BY 1, 2""",
)
def dates_by_month(spark, folder):
    days = t.load(spark, folder, "lineitem").select(F.col("l_shipdate").alias("day"))
    rows = periods.dates_by_month(days)
    return rows.select(
        F.col("year").cast("bigint").alias("year"),
        F.col("month").cast("bigint").alias("month"),
        F.size("days").cast("bigint").alias("n"),
        F.array_join(F.transform("days", lambda d: F.date_format(d, "dd")), ",").alias("days"),
    )


@query(
    "day_counts",
    """SELECT d AS "day", count(l_orderkey) AS n FROM (SELECT unnest(generate_series(
      TIMESTAMP '1999-12-25', TIMESTAMP '2000-03-05', INTERVAL 1 DAY)) AS d)
    LEFT JOIN lineitem ON l_shipdate = d GROUP BY 1""",
)
def day_counts(spark, folder):
    """Shipments on every day of a closed range, days without any included."""
    days = periods.day_list(spark, "1999-12-25", "2000-03-05")
    shipped = (
        t.load(spark, folder, "lineitem")
        .groupBy(floor_day(F.col("l_shipdate")).alias("day"))
        .agg(F.count("*").alias("n"))
    )
    return days.join(shipped, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "fit_dates",
    """SELECT strftime(d, '%Y-%m-%d') AS "day" FROM (
      SELECT DISTINCT l_shipdate AS d FROM lineitem WHERE l_shipdate <= '2000-06-30')
    ORDER BY d DESC LIMIT 250""",
)
def fit_dates(spark, folder):
    days = periods.last_days(t.panel(spark, folder), 250, as_of="2000-06-30")
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day"))


TENORS = """CASE c_custkey % 6 WHEN 0 THEN (c_custkey % 30 + 1) || 'D'
  WHEN 1 THEN (c_custkey % 8 + 1) || 'w' WHEN 2 THEN (c_custkey % 24 + 1) || ' M'
  WHEN 3 THEN (c_custkey % 30 + 1) || '.5Y' WHEN 4 THEN (c_custkey % 30) || 'y' ELSE 'spot' END"""


def tenor_text():
    key = F.col("c_custkey")

    def number(n, plus=1):
        return (key % n + plus).cast("string")

    return (
        F.when(key % 6 == 0, F.concat(number(30), F.lit("D")))
        .when(key % 6 == 1, F.concat(number(8), F.lit("w")))
        .when(key % 6 == 2, F.concat(number(24), F.lit(" M")))
        .when(key % 6 == 3, F.concat(number(30), F.lit(".5Y")))
        .when(key % 6 == 4, F.concat(number(30, 0), F.lit("y")))
        .otherwise("spot")
    )


MONTHS = """CASE c_custkey % 6 WHEN 0 THEN (c_custkey % 30 + 1) / 30.0
  WHEN 1 THEN (c_custkey % 8 + 1) / 4.345 WHEN 2 THEN c_custkey % 24 + 1
  WHEN 3 THEN (c_custkey % 30 + 1.5) * 12 WHEN 4 THEN (c_custkey % 30) * 12
  ELSE 1e9 END"""


@query(
    "tenor_sort",
    f"""SELECT c_custkey AS id, {TENORS} AS tenor, round(({MONTHS})::DOUBLE, 6) AS months
    FROM customer""",
)
def tenor_sort(spark, folder):
    """Tenor lengths; text that is no tenor sorts last (shown as a very large number)."""
    months = F.least(tenor_months(F.col("tenor")), F.lit(1e9))
    return (
        t.load(spark, folder, "customer")
        .select(F.col("c_custkey").alias("id"), tenor_text().alias("tenor"))
        .withColumn("months", F.round(months, 6))
    )


@query(
    "parse_timestamps",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 < 6 THEN o_orderdate END AS parsed
    FROM orders""",
)
def parse_timestamps(spark, folder):
    """Order dates written in several layouts, read back; junk is NULL."""
    key = F.col("o_orderkey") % 7
    day = F.col("o_orderdate")
    text = (
        F.when(key == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key == 1, F.date_format(day, "yyyyMMdd"))
        .when(key == 2, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(key == 3, F.date_format(day, "dd MMM yyyy"))
        .when(key == 4, F.date_format(day, "MMMM d, yyyy"))
        .when(key == 5, F.date_format(day, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .otherwise("not a date")
    )
    return t.load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), parse_timestamp(text).alias("parsed")
    )


@query(
    "utc_days",
    """SELECT event_id AS id, date_trunc('day', ts)::TIMESTAMP AS "day",
       date_trunc('millisecond', ts) AS ms, date_trunc('day', ts + INTERVAL 5 HOUR)::TIMESTAMP AS shifted,
       floor(epoch(TIMESTAMP '2024-02-01' - ts) / 86400)::BIGINT AS age FROM events""",
)
def utc_days(spark, folder):
    """Midnight, millisecond precision, another zone's time in UTC, and age in days."""
    ts = F.col("ts")
    as_of = F.lit("2024-02-01").cast("timestamp_ntz")
    return t.load(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        floor_day(ts).alias("day"),
        truncate_precision(ts, 3).alias("ms"),
        floor_day(to_utc(ts, "America/Bogota")).alias("shifted"),
        age_days(as_of, ts).cast("bigint").alias("age"),
    )


@query(
    "daily_last",
    views(TICKS)
    + """SELECT series_code, date_trunc('day', "timestamp")::TIMESTAMP AS "timestamp",
       arg_max("value", ("timestamp", _seq)) AS "value" FROM ticks GROUP BY 1, 2""",
)
def daily_last(spark, folder):
    return periods.daily_last(t.ticks(spark, folder))


@query(
    "last_wins_sparse",
    views(SPARSE, last_wins_sql("sparse")) + "SELECT * FROM sparse_last",
)
def last_wins_sparse(spark, folder):
    """Hot keys: a fifth of all orders under each series."""
    return last_wins(t.sparse(spark, folder))
