"""The currency world's values on line items and suppliers that do not match one to one."""

from __future__ import annotations

from datetime import datetime

import pytest
from oracle import compare

import __spark_entry__ as entry_point

DAY = datetime(2000, 1, 3)
#: Suppliers' keys and nations: key 2 twice, in two nations; key 3 twice in one; none of key 9.
SUPPLIERS = [(1, 2), (2, 3), (2, 4), (3, 5), (3, 5)]
LINES = [
    # supplier, quantity, price, discount, tax, flag, status
    (1, 10.0, 1000.0, 0.01, 0.02, "A", "F"),
    (1, 12.0, None, None, 0.03, "R", "F"),
    (2, 14.0, 3000.0, 0.05, 0.04, "N", "O"),
    (3, 15.0, 3500.0, 0.06, 0.05, "N", "O"),
    (9, 16.0, 9000.0, 0.07, None, "R", "F"),
    (None, None, 5000.0, 0.09, 0.08, "N", "F"),
]


@pytest.fixture
def folder(spark, tmp_path):
    def save(rows, schema, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "parts" / name))
        part = next((tmp_path / "parts" / name).glob("*.parquet"))
        (tmp_path / "tables" / f"{name}.parquet").write_bytes(part.read_bytes())

    (tmp_path / "tables").mkdir()
    save(SUPPLIERS, "s_suppkey long, s_nationkey int", "supplier")
    save(
        [(*line, DAY) for line in LINES],
        "l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        "lineitem",
    )
    save([(DAY, 997.0)], "o_orderdate timestamp_ntz, o_totalprice double", "orders")
    return str(tmp_path / "tables")


def test_lines_count_once_for_the_world_and_for_every_supplier_of_their_key(spark, folder):
    run, sql = entry_point.queries()["fx_values"], entry_point.oracle_sql()["fx_values"]
    assert compare(spark, run, sql, folder) is None
