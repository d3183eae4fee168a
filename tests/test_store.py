from __future__ import annotations

from datetime import datetime

import pytest
from conftest import records
from pyspark.sql import functions as F
from pyspark.sql import types as T

from serieslake.schema import SnapshotConflictError, SnapshotNotFoundError
from serieslake.sources.cache import QueryCache, encryption_options
from serieslake.sources.store import Lake, common_folder


@pytest.fixture
def table(spark, tmp_path):
    return Lake(spark, str(tmp_path)).table("gold", "things")


def frame(spark, rows, schema="key string, n int"):
    return spark.createDataFrame(rows, schema)


def test_snapshots(spark, table):
    table.append(frame(spark, [("a", 1)]), commit_ts=datetime(2024, 1, 1))
    table.append(frame(spark, [("a", 2)]), commit_ts=datetime(2024, 2, 1))
    assert records(table.read()) == [("a", 1), ("a", 2)]
    assert records(table.read(version=1)) == [("a", 1)]
    assert records(table.read(as_of="2024-01-15")) == [("a", 1)]
    assert table.snapshots().count() == 2
    with pytest.raises(SnapshotNotFoundError):
        table.read(as_of=datetime(2023, 1, 1))
    with pytest.raises(SnapshotConflictError):
        table.read(version=1, as_of="2024-01-01")


@pytest.mark.parametrize("narrow_first", [True, False])
def test_columns_widen_in_either_order(spark, table, narrow_first):
    narrow = frame(spark, [("a", 1)])
    wide = frame(spark, [("b", 2, 0.5)], "KEY string, n int, extra double")
    for part in (narrow, wide) if narrow_first else (wide, narrow):
        table.append(part)
    assert records(table.read().select("key", "n", "extra")) == [("a", 1, None), ("b", 2, 0.5)]


def test_types_do_not_flip(spark, table):
    table.append(frame(spark, [("a", 1)]))
    table.append(frame(spark, [("b", "7")], "key string, n string"))
    assert table.read().schema["n"].dataType == T.IntegerType()


def test_replace_hides_only_older_rows_of_the_same_keys(spark, table):
    table.append(frame(spark, [("a", 1), ("b", 1), (None, 1)]))
    table.replace(frame(spark, [("a", 2), ("a", 3)]), "key")
    assert records(table.read()) == [("a", 2), ("a", 3), ("b", 1), (None, 1)]
    assert records(table.read(version=1)) == [("a", 1), ("b", 1), (None, 1)]
    table.append(frame(spark, [("a", 4)]))
    assert ("a", 4) in records(table.read())


def test_delete_by_values(spark, table):
    table.append(frame(spark, [("a", 1), ("a", 2), (None, 3)]))
    table.delete({"key": "a", "n": 2})
    assert records(table.read()) == [("a", 1), (None, 3)]
    table.append(frame(spark, [("a", 2)]))
    assert ("a", 2) in records(table.read())
    table.delete()
    assert table.read().count() == 0


def test_uncommitted_files_are_invisible(spark, table):
    table.append(frame(spark, [("a", 1)]))
    orphan = frame(spark, [("x", 9)]).withColumn("_version", F.lit(2)).withColumn("_seq", F.lit(0))
    orphan.write.parquet(f"{table.path}/data/_commit=dead")
    assert records(table.read()) == [("a", 1)]


def test_empty_append_commits_nothing(spark, table):
    assert table.append(frame(spark, [])) is None
    assert not table.exists()
    assert table.read().columns == []


def test_create_is_idempotent(spark, table):
    schema = T.StructType([T.StructField("key", T.StringType())])
    table.create(schema)
    table.create(schema)
    assert table.snapshots().count() == 1 and table.read().count() == 0
    table.append(frame(spark, [("a", 1)]))
    assert records(table.read()) == [("a", 1)]


def test_paths_and_staleness(spark, table):
    assert table.storage_path() is None and table.is_stale(1e9)
    table.append(frame(spark, [("a", 1)]), commit_ts=datetime(2024, 1, 1))
    assert table.storage_path().endswith("things/data") or "_commit=" in table.storage_path()
    assert table.is_stale(60, now=datetime(2024, 1, 2)) and not table.is_stale(1e6, now=datetime(2024, 1, 2))
    assert common_folder(["file:/x/a/1.parquet", "file:/x/b/2.parquet"]) == "file:/x"
    assert common_folder([]) is None


def test_partition_pruning(spark, tmp_path):
    table = Lake(spark, str(tmp_path)).table("main", "v", partition_by=["src", "year"])
    table.append(frame(spark, [("a", "x", 2020), ("b", "y", 2021)], "key string, src string, year int"))
    found = table.read().filter("src = 'x' AND year >= 2020")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(src" in plan
    assert records(found, "key") == [("a",)]


def test_query_cache(spark, tmp_path):
    cache = QueryCache(spark)
    path = str(tmp_path / "saved")
    assert cache.load(path) is None and cache.is_stale(path, 1e9)
    cache.save("SELECT key, n * 2 AS n FROM {t}", path, t=frame(spark, [("a", 1), ("b", 2)]))
    assert records(cache.load(path)) == [("a", 2), ("b", 4)]
    assert records(cache.load(path, "SELECT sum(n) AS s FROM {saved}")) == [(6,)]
    assert cache.load(path, "SELECT * FROM {saved} WHERE n > 100") is None
    assert not cache.is_stale(path, 3600) and cache.is_stale(path, -1)


def test_encryption_options():
    options = encryption_options("factory", "footer", {"k": ["a", "b"]})
    assert options["parquet.encryption.column.keys"] == "k:a,b"


def test_delete_compares_in_the_type_of_the_column(spark, tmp_path):
    from serieslake.schema import InvalidFilterFieldError, InvalidQueryError
    from serieslake.sources.store import Lake

    rows = [("A", "2024-01-01", 3.0), ("A", "2024-01-02", 4.0), ("B", "2024-01-01", 5.0)]
    frame = spark.createDataFrame(rows, "series_code string, timestamp string, value double")
    frame = frame.withColumn("timestamp", frame["timestamp"].cast("timestamp_ntz"))
    table = Lake(spark, str(tmp_path)).table("main", "typed")
    table.append(frame)
    table.delete({"value": 3})
    assert sorted(r.value for r in table.read().collect()) == [4.0, 5.0]
    table.delete({"timestamp": "2024-01-01"})
    assert [r.value for r in table.read().collect()] == [4.0]
    with pytest.raises(InvalidFilterFieldError):
        table.delete({"nothing": 1})
    with pytest.raises(InvalidQueryError):
        table.delete({"value": "many"})
    assert table.read().count() == 1
