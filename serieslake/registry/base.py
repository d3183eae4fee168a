"""Registration of queries and the SQL views their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CATALOG = """catalog AS (
  SELECT 'C' || c_custkey AS series_code, c_name AS series_name, c_mktsegment AS asset_class,
         n_name AS currency, r_name AS region,
         CASE WHEN c_acctbal >= 5000 THEN 'high' WHEN c_acctbal >= 0 THEN 'low' END AS rating
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""
VALS = """vals AS (
  SELECT 'C' || o_custkey AS series_code, o_orderdate AS "timestamp", o_totalprice AS "value",
         CASE o_orderstatus WHEN 'O' THEN 'bloomberg' WHEN 'F' THEN 'hawk' ELSE 'mds' END
           AS ticker_source, o_orderkey AS _seq
  FROM orders)"""
PANEL = """panel AS (
  SELECT l_returnflag || '_' || l_linestatus AS series_code, l_shipdate AS "timestamp",
         avg(l_extendedprice) / 1.03 AS "value"
  FROM lineitem GROUP BY 1, 2)"""
SPARSE = """sparse AS (
  SELECT o_orderpriority AS series_code, o_orderdate AS "timestamp", o_totalprice AS "value",
         o_orderkey AS _seq FROM orders)"""
TICKS = """ticks AS (
  SELECT event_type AS series_code, ts AS "timestamp", "value", event_id AS _seq FROM events)"""


def last_wins_sql(table: str) -> str:
    """Oracle view: latest saved value per (series, timestamp)."""
    return (
        f'{table}_last AS (SELECT series_code, "timestamp", arg_max("value", _seq) AS "value" '
        f"FROM {table} GROUP BY 1, 2)"
    )


def views(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its oracle when SQL can express it."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def rounded(column: Column | str, digits: int = 6) -> Column:
    """Rounded, with negative zero turned into zero."""
    return F.round(column, digits) + F.lit(0.0)


def figure(column: Column | str, digits: int = 5) -> Column:
    """A number to so many digits after the first one."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}e", value).cast("double") + F.lit(0.0))
