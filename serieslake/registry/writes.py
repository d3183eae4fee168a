"""Queries of what writes promise: winners, counts, replaced runs; and reads through the API."""

from __future__ import annotations

import warnings
from datetime import datetime

from pyspark.sql import functions as F

from serieslake.api import DataAPI
from serieslake.operators.reshape import pivot_values
from serieslake.operators.values import last_wins
from serieslake.plans import model, results
from serieslake.plans.universes import UNIVERSES
from serieslake.registry import fits
from serieslake.registry import tables as t
from serieslake.registry.base import CATALOG, TICKS, VALS, query, views
from serieslake.registry.fairvalue import FEATURE_VIEWS, MODEL_DAY
from serieslake.schema import SEQ, SERIES_CODE, TICKER_SOURCE, TIMESTAMP, VALUE
from serieslake.session import scratch_path

KINDS = ["click", "error", "purchase", "signup", "view"]


def _api(spark) -> DataAPI:
    return DataAPI(spark, scratch_path(spark, "lake"))


@query(
    "wide_intraday",
    views(TICKS)
    + """SELECT series_code, date_trunc('day', "timestamp")::TIMESTAMP AS "timestamp",
       arg_max("value", "timestamp") AS "value", 'bloomberg' AS ticker_source FROM ticks GROUP BY 1, 2""",
)
def wide_intraday(spark, folder):
    """A wide frame with many rows a day, written and read back: the latest time wins."""
    api = _api(spark)
    wide = pivot_values(t.ticks(spark, folder), KINDS, sort=False)
    api.write_values(wide.repartition(7), ticker_source="bloomberg")
    return api.values_frame().select(SERIES_CODE, TIMESTAMP, VALUE, TICKER_SOURCE)


@query(
    "lost_values",
    views(VALS)
    + """SELECT count(*) FILTER (_seq % 7 = 0) AS lost, count(*) FILTER (_seq % 7 <> 0) AS stored,
       count(*) AS "rows" FROM vals""",
)
def lost_values(spark, folder):
    """Text that is no number is stored as missing; the write's own job counts it."""
    api = _api(spark)
    text = F.when(F.col(SEQ) % 7 == 0, F.concat(F.lit("x"), F.col(SEQ))).otherwise(F.col(VALUE).cast("string"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        api.write_values(t.values(spark, folder).withColumn(VALUE, text).drop(SEQ))
    count, _ = api.lost_values
    return api.values_frame().agg(
        F.max(F.lit(count)).cast("long").alias("lost"),
        F.count(VALUE).alias("stored"),
        F.count(F.lit(1)).alias("rows"),
    )


@query(
    "resaved_by_order",
    views(VALS)
    + """SELECT series_code, "timestamp", arg_max("value", _seq) AS "value", count(*) AS saves
    FROM vals GROUP BY 1, 2""",
)
def resaved_by_order(spark, folder):
    """The latest save of every (series, day), repeated saves of one vendor within one write included."""
    api = _api(spark)
    api.write_values(t.values(spark, folder).repartition(5), save_order=SEQ)
    frame = api.values_frame()
    saves = frame.groupBy(SERIES_CODE, TIMESTAMP).agg(F.count("*").alias("saves"))
    return last_wins(frame).join(saves, [SERIES_CODE, TIMESTAMP]).select(SERIES_CODE, TIMESTAMP, VALUE, "saves")


@query(
    "backfill_twice",
    fits.with_views(*FEATURE_VIEWS, fits.last_dates(2, MODEL_DAY), *fits.FITS)
    + """SELECT universe, as_of::DATE AS as_of, count(*) AS summaries,
       sum(n)::BIGINT AS window_rows FROM fits GROUP BY 1, 2""",
)
def backfill_twice(spark, folder):
    """A run that is repeated leaves the rows of one run in both result tables."""
    api = _api(spark)
    found = model.fit_universes(
        t.fx_catalog(spark, folder), t.fx_values(spark, folder), as_of=MODEL_DAY, lookback_days=2
    )
    for _ in range(2):
        for name in UNIVERSES:
            found[name].save(api)
    keys = ["universe", "as_of"]
    read = {name: api.read_table(results.GOLD, name).frame for name in (results.SUMMARY_TABLE, results.ROWS_TABLE)}
    summaries = read[results.SUMMARY_TABLE].groupBy(*keys).agg(F.count("*").alias("summaries"))
    rows = read[results.ROWS_TABLE].groupBy(*keys).agg(F.count("*").alias("window_rows"))
    return summaries.join(rows, keys)


MARKET = "AUTOMOBILE"


def _loaded(spark, folder) -> DataAPI:
    """A lake with the catalog and one commit of values per vendor."""
    api = _api(spark)
    api.import_metadata(t.catalog(spark, folder))
    rows = t.values(spark, folder)
    for day, vendor in enumerate(("bloomberg", "hawk", "mds"), start=1):
        api.write_values(
            rows.filter(F.col(TICKER_SOURCE) == vendor), commit_ts=datetime(2024, 1, day), save_order=SEQ
        )
    return api


LAST = views(CATALOG, VALS).rstrip() + f""",
ranked AS (
  SELECT v.series_code, "timestamp", "value", ticker_source,
         CASE ticker_source WHEN 'bloomberg' THEN 1 WHEN 'hawk' THEN 2 ELSE 3 END AS version, _seq
  FROM vals v JOIN catalog c ON v.series_code = c.series_code WHERE asset_class = '{MARKET}')
"""


@query(
    "api_value_wide",
    LAST
    + """SELECT "timestamp", count(DISTINCT series_code) AS known, round(sum("value"), 2) AS total FROM (
      SELECT series_code, "timestamp", arg_max("value", (version, _seq)) AS "value" FROM ranked GROUP BY 1, 2)
    WHERE "timestamp" BETWEEN '1996-01-01' AND '1997-12-31' GROUP BY 1""",
)
def api_value_wide(spark, folder):
    """The wide rows of a filtered query over two years, added up at any width."""
    query = _loaded(spark, folder).query().filter(asset_class=MARKET).between("1996-01-01", "1997-12-31")
    return query.value_totals().withColumn("total", F.round("total", 2))


@query(
    "api_last_value_wide",
    LAST
    + """SELECT "timestamp", count(*) AS known, round(sum("value"), 2) AS total FROM (
      SELECT series_code, max("timestamp") AS "timestamp",
             arg_max("value", ("timestamp", version, _seq)) AS "value" FROM ranked GROUP BY 1) GROUP BY 1""",
)
def api_last_value_wide(spark, folder):
    """The wide rows of each series' last value, added up at any width."""
    query = _loaded(spark, folder).query().filter(asset_class=MARKET)
    return query.last_value_totals().withColumn("total", F.round("total", 2))


@query(
    "api_snapshots",
    """SELECT * FROM (VALUES (1, TIMESTAMP '2024-01-01'), (2, TIMESTAMP '2024-01-02'), (3, TIMESTAMP '2024-01-03'))
    AS s(version, commit_ts) JOIN (SELECT count(*) AS "rows" FROM orders) ON true""",
)
def api_snapshots(spark, folder):
    """The commits of the values table, beside the rows that the newest one shows."""
    api = _loaded(spark, folder)
    count = api.values_frame().count()
    listed = api.list_snapshots().filter("version >= 1")
    return listed.select(
        F.col("version").cast("int").alias("version"), "commit_ts", F.lit(count).cast("long").alias("rows")
    )


@query(
    "api_metadata_ends",
    views(CATALOG)
    + """SELECT 'first' AS part, * FROM (SELECT * FROM catalog ORDER BY series_code LIMIT 5)
    UNION ALL SELECT 'last', * FROM (SELECT * FROM catalog ORDER BY series_code DESC LIMIT 5)""",
)
def api_metadata_ends(spark, folder):
    """The first and last rows of a catalog read through the API."""
    found = _loaded(spark, folder).get_metadata()
    first = found.first(5).withColumn("part", F.lit("first"))
    return first.unionByName(found.last(5).withColumn("part", F.lit("last")))
