"""Store, import and export queries: data is written to the shared folder and read back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from serieslake.api import DataAPI
from serieslake.operators import values
from serieslake.registry import tables as t
from serieslake.registry.base import CATALOG, SPARSE, VALS, last_wins_sql, query, rounded, views
from serieslake.schema import SEQ, SERIES_CODE, TICKER_SOURCE, TIMESTAMP, VALUE
from serieslake.session import scratch_path
from serieslake.sources.cache import QueryCache
from serieslake.sources.files import coerce_values, coercion_report, strip_text

MOMENTS = [datetime(2024, 1, day) for day in (1, 2, 3)]


def _api(spark) -> DataAPI:
    return DataAPI(spark, scratch_path(spark, "lake"))


def _three_commits(spark, folder) -> DataAPI:
    """Values saved vendor by vendor; the last commit re-saves one vendor's rows doubled."""
    api = _api(spark)
    rows = t.values(spark, folder).drop(SEQ)
    hawk = rows.filter(F.col(TICKER_SOURCE) == "hawk")
    api.write_values(hawk, commit_ts=MOMENTS[0])
    api.write_values(rows.filter(F.col(TICKER_SOURCE) == "bloomberg"), commit_ts=MOMENTS[1])
    api.write_values(hawk.withColumn(VALUE, F.col(VALUE) * 2), commit_ts=MOMENTS[2])
    return api


LONG = 'series_code, "timestamp", "value", ticker_source'


@query(
    "version_read",
    views(VALS) + f"SELECT {LONG} FROM vals WHERE ticker_source IN ('hawk', 'bloomberg')",
)
def version_read(spark, folder):
    frame = _three_commits(spark, folder).values_frame(version=2)
    return frame.select(SERIES_CODE, TIMESTAMP, VALUE, TICKER_SOURCE)


@query(
    "as_of_read",
    views(VALS) + f"SELECT {LONG} FROM vals WHERE ticker_source = 'hawk'",
)
def as_of_read(spark, folder):
    frame = _three_commits(spark, folder).values_frame(as_of="2024-01-01 12:00:00")
    return frame.select(SERIES_CODE, TIMESTAMP, VALUE, TICKER_SOURCE)


@query(
    "resaved_last_wins",
    views(VALS)
    + """SELECT series_code, "timestamp", max("value") AS "value", max(n) AS saves FROM (
      SELECT series_code, "timestamp",
             CASE WHEN ticker_source = 'hawk' THEN "value" * 2 ELSE "value" END AS "value",
             sum(CASE WHEN ticker_source = 'hawk' THEN 2 ELSE 1 END)
               OVER (PARTITION BY series_code, "timestamp")::BIGINT AS n,
             row_number() OVER (PARTITION BY series_code, "timestamp"
               ORDER BY ticker_source = 'hawk' DESC) AS r,
             count(*) OVER (PARTITION BY series_code, "timestamp", ticker_source) AS same
      FROM vals WHERE ticker_source IN ('hawk', 'bloomberg'))
    WHERE r = 1 AND same = 1 GROUP BY 1, 2""",
)
def resaved_last_wins(spark, folder):
    """Latest save per (series, timestamp); pairs one vendor saved twice at once are left out,
    since nothing in the data says which of those came later."""
    frame = _three_commits(spark, folder).values_frame()
    unclear = (
        t.values(spark, folder)
        .groupBy(SERIES_CODE, TIMESTAMP, TICKER_SOURCE)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )
    latest = values.last_wins(frame, TICKER_SOURCE)
    saves = frame.groupBy(SERIES_CODE, TIMESTAMP).agg(F.count("*").alias("saves"))
    keys = [SERIES_CODE, TIMESTAMP, TICKER_SOURCE]
    return (
        latest.join(unclear, keys, "left_anti")
        .join(saves, [SERIES_CODE, TIMESTAMP])
        .select(SERIES_CODE, TIMESTAMP, VALUE, "saves")
    )


@query(
    "partitioned_range_read",
    views(VALS)
    + f"""SELECT {LONG} FROM vals WHERE ticker_source = 'hawk'
    AND "timestamp" BETWEEN '1996-06-01' AND '1997-05-31'""",
)
def partitioned_range_read(spark, folder):
    """Vendor and year folders outside the request are never opened."""
    api = _api(spark)
    api.write_values(t.values(spark, folder).drop(SEQ))
    rows = values.scan(api.values_frame(), source="hawk", start="1996-06-01", end="1997-05-31")
    return rows.select(SERIES_CODE, TIMESTAMP, VALUE, TICKER_SOURCE)


@query(
    "delete_values",
    views(VALS) + f"SELECT {LONG} FROM vals WHERE ticker_source <> 'hawk'",
)
def delete_values(spark, folder):
    api = _api(spark)
    api.write_values(t.values(spark, folder).drop(SEQ))
    api.delete_values(ticker_source="hawk")
    return api.values_frame().select(SERIES_CODE, TIMESTAMP, VALUE, TICKER_SOURCE)


@query(
    "fresh_replace",
    views(CATALOG)
    + """SELECT series_code, CASE WHEN region = 'ASIA' THEN upper(series_name) ELSE series_name END
       AS series_name, asset_class, currency, region,
       CASE WHEN region <> 'ASIA' THEN rating END AS rating,
       CASE WHEN region = 'ASIA' THEN 'yes' END AS renamed FROM catalog""",
)
def fresh_replace(spark, folder):
    """A fresh import replaces rows of the same series and widens the table."""
    api = _api(spark)
    catalog = t.catalog(spark, folder)
    api.import_metadata(catalog)
    asia = catalog.filter("region = 'ASIA'").drop("rating")
    renamed = asia.withColumn("series_name", F.upper("series_name"))
    api.import_metadata(renamed.withColumn("renamed", F.lit("yes")), fresh=True)
    return api.catalog()


@query(
    "csv_ingest",
    views(CATALOG) + "SELECT * FROM catalog WHERE region IN ('ASIA', 'EUROPE')",
)
def csv_ingest(spark, folder):
    """Catalog exported as text files, imported from them, and filtered."""
    path = scratch_path(spark, "export") + ".csv"
    t.catalog(spark, folder).write.csv(path, header=True)
    api = _api(spark)
    api.import_metadata(path=path)
    return api.query().filter(region=["ASIA", "EUROPE"]).metadata()


@query(
    "fluent_value",
    views(CATALOG, VALS)
    + """SELECT region, date_trunc('month', "timestamp") AS "timestamp",
       round(sum("value"), 2) AS total, count(*) AS n
    FROM vals v JOIN catalog c ON v.series_code = c.series_code
    WHERE asset_class = 'BUILDING' AND region <> 'ASIA' AND ticker_source = 'bloomberg'
      AND "timestamp" BETWEEN '1996-01-01' AND '1999-12-31' GROUP BY 1, 2""",
)
def fluent_value(spark, folder):
    """A chained query over stored tables, grouped by a catalog column, as one plan."""
    api = _api(spark)
    api.import_metadata(t.catalog(spark, folder))
    api.write_values(t.values(spark, folder).drop(SEQ))
    rows = (
        api.query()
        .filter(asset_class="BUILDING")
        .exclude(region="ASIA")
        .source("BBG")
        .between("1996-01-01", "1999-12-31")
        .grouped_values("region")
    )
    month = F.date_trunc("month", TIMESTAMP).cast("timestamp_ntz").alias(TIMESTAMP)
    return rows.groupBy("region", month).agg(
        F.round(F.sum(VALUE), 2).alias("total"), F.count("*").alias("n")
    )


@query(
    "wide_round_trip",
    views(SPARSE, last_wins_sql("sparse"))
    + """SELECT series_code, "timestamp", "value", 'mds' AS ticker_source FROM sparse_last""",
)
def wide_round_trip(spark, folder):
    """Wide values written back without naming their vendor: the frame remembers it."""
    api = _api(spark)
    rows = t.sparse(spark, folder).withColumn(TICKER_SOURCE, F.lit("mds"))
    api.write_values(values.last_wins(rows, TICKER_SOURCE))
    wide = api.get_values(t.PRIORITIES, ticker_source="onetick")
    copy = _api(spark)
    copy.write_values(wide)
    return copy.values_frame().select(SERIES_CODE, TIMESTAMP, VALUE, TICKER_SOURCE)


@query(
    "generic_table_widen",
    """SELECT n_name AS name, n_regionkey AS region, CAST(NULL AS DOUBLE) AS balance FROM nation
    UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier""",
)
def generic_table_widen(spark, folder):
    api = _api(spark)
    nation = t.load(spark, folder, "nation")
    supplier = t.load(spark, folder, "supplier")
    api.write_table(
        "gold", "names", nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    )
    api.write_table(
        "gold", "names", supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("NAME"))
    )
    return api.read_table("gold", "names").frame


@query(
    "coerce_numeric",
    """SELECT 'C' || o_custkey AS series_code, o_orderdate AS "timestamp",
       CASE WHEN o_orderkey % 10 >= 3 THEN o_totalprice END AS "value" FROM orders""",
)
def coerce_numeric(spark, folder):
    return coerce_values(_text_values(spark, folder))


def _text_values(spark, folder):
    key = F.col("o_orderkey") % 10
    text = (
        F.when(key == 0, "N/A")
        .when(key == 1, "NaN")
        .when(key == 2, "#N/A N/A")
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    return t.load(spark, folder, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias(SERIES_CODE),
        F.col("o_orderdate").alias(TIMESTAMP),
        text.alias(VALUE),
    )


@query(
    "coercion_report",
    """SELECT CASE o_orderkey % 10 WHEN 0 THEN 'N/A' WHEN 1 THEN 'NaN' ELSE '#N/A N/A' END AS "text",
       count(*) AS n FROM orders WHERE o_orderkey % 10 < 3 GROUP BY 1""",
)
def coercion_counts(spark, folder):
    return coercion_report(_text_values(spark, folder))


@query(
    "strip_whitespace",
    """SELECT c_custkey AS id, c_name AS name,
       CASE WHEN c_nationkey % 5 <> 0 THEN c_mktsegment END AS segment FROM customer""",
)
def strip_whitespace(spark, folder):
    padded = t.load(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit("\t ")).alias("name"),
        F.when(F.col("c_nationkey") % 5 == 0, "   ").otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    return strip_text(padded)


@query(
    "query_cache",
    """SELECT o_orderstatus AS status, count(*) AS n, round(avg(o_totalprice) / 1.03, 4) AS mean
    FROM orders WHERE o_totalprice > 100000 GROUP BY 1""",
)
def query_cache(spark, folder):
    """A query's result saved as Parquet and queried again."""
    cache = QueryCache(spark)
    path = scratch_path(spark, "cache")
    cache.save(
        "SELECT o_orderstatus AS status, o_totalprice FROM {orders} WHERE o_totalprice > 100000",
        path,
        orders=t.load(spark, folder, "orders"),
    )
    saved = cache.load(
        path, "SELECT status, count(*) AS n, avg(o_totalprice) AS mean FROM {saved} GROUP BY status"
    )
    return saved.withColumn("mean", rounded(F.col("mean") / 1.03, 4))
