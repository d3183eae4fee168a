from __future__ import annotations

import io
import zipfile
from datetime import datetime

import pytest
from conftest import records
from pyspark.sql import functions as F

from serieslake.api import DataAPI
from serieslake.datasets import FXMajor, FXSpot
from serieslake.operators.quality import Rule
from serieslake.plans.batch import load_catalog, load_vendor_values
from serieslake.schema import (
    DirectFetchUnavailableError,
    FrameValidationError,
    InvalidImportSourceError,
    InvalidQueryError,
    MissingMetadataColumnError,
    SnapshotConflictError,
    SnapshotNotFoundError,
    TickerSourceRequiredError,
    UnsupportedFileTypeError,
    UnsupportedVendorError,
)
from serieslake.sources.files import read_tabular
from serieslake.sources.vendors import VendorRegistry, table_reader

SPOT = ("Currency", "Forex Spot", "G10")
CATALOG = "series_code string, asset_class string, sub_asset_class string, market_development string, currency string"


@pytest.fixture
def catalog(spark):
    rows = [("EURUSD", *SPOT, "EUR"), ("GBPUSD", *SPOT, "GBP"), ("USDJPY", *SPOT, "JPY"), ("SPX", "Equity", "Index", None, "USD")]
    return spark.createDataFrame(rows, CATALOG)


@pytest.fixture
def api(spark, tmp_path, catalog, long):
    api = DataAPI(spark, str(tmp_path))
    api.import_metadata(catalog)
    api.write_values(
        long([("EURUSD", "2024-01-01", 1.10), ("EURUSD", "2024-01-02", 1.11), ("GBPUSD", "2024-01-01", 1.25),
              ("GBPUSD", "2024-01-02", 1.26), ("USDJPY", "2024-01-02", 148.0)]),
        ticker_source="bloomberg",
    )
    return api


def test_fluent_query(api):
    wide = api.query().filter(asset_class="Currency").between("2024-01-01", "2024-01-31").value()
    assert records(wide) == [
        ("2024-01-01T00:00:00", 1.10, 1.25, None), ("2024-01-02T00:00:00", 1.11, 1.26, 148.0),
    ]
    assert wide.columns == ["timestamp", "EURUSD", "GBPUSD", "USDJPY"]


def test_queries_are_immutable(api):
    base = api.query().filter(asset_class="Currency")
    base.filter(currency="EUR")
    assert base.metadata().count() == 3
    assert base.exclude(currency=["EUR"]).metadata().count() == 2


def test_last_value_honours_the_range(api):
    assert records(api.query().filter(currency="EUR").last_long(), "value") == [(1.11,)]
    early = api.query().filter(currency="EUR").between(None, "2024-01-01")
    assert records(early.last_long(), "value") == [(1.10,)]


def test_limit_cuts_long_rows_before_the_pivot(api):
    wide = api.get_values(["EURUSD", "GBPUSD"], limit=3, order_by="timestamp")
    assert records(wide) == [("2024-01-01T00:00:00", 1.10, 1.25), ("2024-01-02T00:00:00", 1.11, None)]


def test_options_and_groups(api):
    assert api.filter_options("currency", asset_class="Currency") == ["EUR", "GBP", "JPY"]
    assert api.query().filter(asset_class="Equity").filter_options()["series_code"] == ["SPX"]
    groups = {key: q.metadata().count() for key, q in api.query().groupby("market_development")}
    assert groups == {("G10",): 3, (None,): 1}


def test_request_rules(api):
    with pytest.raises(InvalidQueryError):
        api.get_values(["EURUSD"], start="2024-02-01", end="2024-01-01")
    with pytest.raises(InvalidQueryError):
        api.query().limit(0).long()
    with pytest.raises(SnapshotConflictError):
        api.get_values(["EURUSD"], version=1, as_of="2024-01-01")
    with pytest.raises(TickerSourceRequiredError):
        api.query().live().long()
    with pytest.raises(DirectFetchUnavailableError):
        api.query().live("BBG").long()


def test_round_trip_keeps_the_vendor(api):
    wide = api.get_values(["EURUSD"], ticker_source="BBG")
    api.write_values(wide)
    sources = api.values_frame().filter("series_code = 'EURUSD'").select("ticker_source").distinct()
    assert records(sources) == [("bloomberg",)]


def test_untagged_rows_get_a_placeholder_source(api, long):
    api.write_values(long([("NEW", "2024-01-01", 1.0)]))
    assert records(api.values_frame().filter("series_code = 'NEW'"), "ticker_source") == [("unknown",)]
    with pytest.raises(FrameValidationError):
        api.write_values(api.spark.createDataFrame([("x",)], "series_code string"))


def test_time_travel(spark, tmp_path, long):
    api = DataAPI(spark, str(tmp_path))
    api.write_values(long([("A", "2024-01-01", 100.0)]), commit_ts=datetime(2024, 1, 2))
    api.write_values(long([("A", "2024-01-01", 200.0)]), commit_ts=datetime(2024, 1, 3))
    assert api.get_values(["A"]).first()["A"] == 200.0
    assert api.get_values(["A"], as_of="2024-01-02 12:00:00").first()["A"] == 100.0
    assert api.get_values(["A"], version=1).first()["A"] == 100.0
    with pytest.raises(SnapshotNotFoundError):
        api.get_values(["A"], as_of="2023-01-01")


def test_metadata_result_chain(api):
    found = api.get_metadata(asset_class="Currency").get_metadata_exclude(currency="EUR")
    assert records(found.series_codes) == [("GBPUSD",), ("USDJPY",)]
    assert found.union(api.get_metadata(series_code="EURUSD")).count() == 3
    assert found.get_last_values().columns == ["timestamp", "GBPUSD", "USDJPY"]
    with pytest.raises(NotImplementedError):
        api.read_table("gold", "nothing").get_values()


def test_import_rules(spark, tmp_path, catalog):
    api = DataAPI(spark, str(tmp_path), metadata_rules=[Rule("known class", "other", F.col("asset_class") == "Junk")])
    with pytest.raises(InvalidImportSourceError):
        api.import_metadata()
    with pytest.raises(FrameValidationError):
        api.import_metadata(catalog.withColumn("series_code", F.lit("  ")))
    with pytest.raises(FrameValidationError, match="known class"):
        api.import_metadata(catalog.withColumn("asset_class", F.lit("Junk")))
    assert api.catalog().count() == 0
    with pytest.raises(UnsupportedFileTypeError):
        api.import_metadata(path="catalog.json")


def test_datasets(api, spark):
    assert FXSpot(api).info.count() == 3
    assert FXMajor(api).matrix().columns == ["timestamp", "EUR", "GBP", "JPY"]
    assert FXSpot(api).get_values(ticker_source="hawk").count() == 0
    with pytest.raises(ValueError):
        FXSpot(api, out_of_cache=True).last_values()
    extra = spark.createDataFrame([("EURUSD_B", *SPOT, "EUR")], CATALOG)
    api.import_metadata(extra)
    api.write_values(api.values_frame().filter("series_code = 'EURUSD'").withColumn("series_code", F.lit("EURUSD_B")))
    with pytest.raises(ValueError, match="EUR"):
        FXMajor(api).matrix()


def vendor_api(spark, path, quotes):
    api = DataAPI(spark, path, vendors=VendorRegistry({"bbg": table_reader(quotes)}))
    catalog = [("A1", "AUDJPY Curncy", "PX_LAST"), ("A2", "AUDJPY Curncy", "PX_LAST"), ("A3", "AUDJPY Curncy", None), ("E", "EURUSD Curncy", "PX_LAST"), ("N", None, None)]
    api.import_metadata(spark.createDataFrame(catalog, "series_code string, bbg_ticker string, bbg_field string"))
    api.import_metadata(
        spark.createDataFrame([("D", "A1|E", "SPREAD")], "series_code string, parent_series_code string, calc_type string"),
        derived=True,
    )
    return api


@pytest.fixture
def quotes(spark):
    return spark.createDataFrame(
        [("AUDJPY Curncy", "PX_LAST", "2024-01-01 17:00:00", 90.0), ("AUDJPY Curncy", "PX_OPEN", "2024-01-01", 1.0),
         ("EURUSD Curncy", "PX_LAST", "2024-01-01", 1.1), ("XAU Curncy", "PX_LAST", "2024-01-01", 2000.0)],
        "ticker string, field string, timestamp string, value double",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_live_reads_fan_out_and_derive(spark, tmp_path, quotes):
    api = vendor_api(spark, str(tmp_path), quotes)
    live = api.query().live("BBG", parents_out_of_cache=True)
    assert records(live.long(), "series_code", "value") == [("A1", 90.0), ("A2", 90.0), ("E", 1.1)]
    both = api.long_values(["A1", "D"], ticker_source="BBG", out_of_cache=True, parents_out_of_cache=True, order_by="value", ascending=False)
    assert [r["series_code"] for r in both.collect()] == ["A1", "D"]
    assert api.long_values(["D"], ticker_source="BBG", out_of_cache=True).count() == 0
    saved = api.ingest("Bloomberg", ["A1", "E"])
    assert records(saved, "series_code", "ticker_source") == [("A1", "bloomberg"), ("E", "bloomberg")]
    derived = api.long_values(["D"], ticker_source="BBG", out_of_cache=True)
    assert records(derived, "value") == [(90.0 - 1.1,)]


def test_vendor_errors(spark, tmp_path, quotes):
    api = vendor_api(spark, str(tmp_path), quotes)
    with pytest.raises(MissingMetadataColumnError):
        api.query().live("hawk").long()
    api.vendors = VendorRegistry()
    with pytest.raises(UnsupportedVendorError):
        api.query().live("bbg").long()


def test_csv_and_value_files(spark, tmp_path):
    api = DataAPI(spark, str(tmp_path / "lake"))
    (tmp_path / "meta.csv").write_text("series_code,series_name\n A1 ,One\nA2,  \n")
    api.import_metadata(path=str(tmp_path / "meta.csv"))
    assert records(api.catalog()) == [("A1", "One"), ("A2", None)]
    (tmp_path / "values.csv").write_text("series_code,timestamp,value\nA1,2024-01-01,1.5\nA1,2024-01-02,NOT FOUND\n")
    api.ingest_value_file(str(tmp_path / "values.csv"))
    assert records(api.values_frame(), "value") == [(1.5,), (None,)]


def workbook(path, rows, name="Data"):
    """A minimal workbook with shared, inline and numeric cells."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared, cells = [], []
    for r, row in enumerate(rows, start=1):
        line = ""
        for c, value in enumerate(row):
            place = f"{chr(65 + c)}{r}"
            if value is None:
                continue
            if isinstance(value, float):
                line += f'<c r="{place}"><v>{value}</v></c>'
            elif c % 2:
                line += f'<c r="{place}" t="inlineStr"><is><t>{value}</t></is></c>'
            else:
                shared.append(value)
                line += f'<c r="{place}" t="s"><v>{len(shared) - 1}</v></c>'
        cells.append(f'<row r="{r}">{line}</row>')
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(cells)}</sheetData></worksheet>')
    path.write_bytes(content.getvalue())


def test_workbooks_with_columns_of_their_own(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", [["series_code", "series_name"], ["A", "Alpha"]])
    workbook(tmp_path / "b.xlsx", [["region", "series_code"], ["ASIA", "B"]])
    workbook(tmp_path / "c.xlsx", [])
    frame = read_tabular(spark, str(tmp_path / "*.xlsx"), sheet="Data")
    assert frame.columns == ["series_code", "series_name", "region"]
    assert records(frame) == [("A", "Alpha", None), ("B", None, "ASIA")]


def test_many_workbooks(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", [["series_code", "series_name"], ["A", "Alpha"], ["B", None]])
    workbook(tmp_path / "b.xlsx", [["series_name", "series_code"], ["Gamma", "C"]])
    frame = read_tabular(spark, str(tmp_path / "*.xlsx"), sheet="Data")
    assert records(frame) == [("A", "Alpha"), ("B", None), ("C", "Gamma")]


def test_tables_widen_and_filter(api, spark):
    api.write_table("gold", "t", spark.createDataFrame([("G10", 1.0)], "universe string, a double"))
    api.write_table("gold", "t", spark.createDataFrame([("CHN", 2.0, 3.0)], "universe string, a double, b double"))
    assert records(api.read_table("gold", "t", universe="G10").frame) == [("G10", 1.0, None)]
    assert api.read_table("gold", "t").filter_options("universe") == ["CHN", "G10"]
    assert api.read_table("gold", "none").frame.columns == []


def test_admin(api):
    api.initialize_schema()
    api.refresh_metadata()
    assert api.list_snapshots().count() == 1
    assert "values" in api.get_values_storage_path()
    assert "currency" in api.get_metadata_columns()
    api.delete_values(series_code="EURUSD")
    assert records(api.value_exists(["EURUSD", "GBPUSD"])) == [("GBPUSD", True)]


def test_scheduled_loads(spark, tmp_path, quotes):
    api = vendor_api(spark, str(tmp_path / "lake"), quotes)
    report = load_vendor_values(api, "BBG")
    assert (report.rows, report.series, report.points, report.passed) == (3, 3, 3, True)
    only = load_vendor_values(api, "BBG", codes=["E"])
    assert (only.rows, only.series) == (1, 1)
    (tmp_path / "meta.csv").write_text("series_code,series_name,bbg_ticker,bbg_field\nE,Euro,EURUSD Curncy,PX_LAST\nZ,Zed,T,\n")
    loaded = load_catalog(api, str(tmp_path / "meta.csv"))
    assert loaded.rows == 6 and not loaded.passed
    assert dict(records(loaded.failures))["pairing"] == 2
    assert loaded.preview.count() == 6


def test_ranges_are_compared_as_moments():
    from datetime import date, datetime

    from serieslake.api import check_request
    from serieslake.schema import InvalidQueryError

    check_request(start=datetime(2024, 1, 1), end="2024-01-01")
    check_request(start=date(2024, 1, 1), end=datetime(2024, 1, 1, 5))
    with pytest.raises(InvalidQueryError):
        check_request(start="2024-01-02", end=date(2024, 1, 1))
    with pytest.raises(InvalidQueryError):
        check_request(start="soon", end="2024-01-01")


def test_live_quotes_of_a_day_keep_the_last(spark):
    from serieslake.sources.vendors import VendorRegistry, live_values, table_reader

    quotes = spark.createDataFrame(
        [("T", "F", "2024-01-01 09:00:00", 9.0), ("T", "F", "2024-01-01 17:00:00", 5.0)],
        "ticker string, field string, timestamp string, value double",
    )
    quotes = quotes.withColumn("timestamp", quotes["timestamp"].cast("timestamp_ntz"))
    catalog = spark.createDataFrame([("S", "T", "F")], "series_code string, hawk_ticker string, field string")
    from serieslake.schema import vendor_columns

    ticker, field = vendor_columns("hawk")
    catalog = catalog.toDF("series_code", ticker, field)
    rows = live_values(
        VendorRegistry({"hawkeye": table_reader(quotes)}), catalog, catalog.select("series_code"), "hawkeye"
    ).collect()
    assert [(r.series_code, r.value) for r in rows] == [("S", 5.0)]


def test_lost_values_are_counted_in_the_write(spark, tmp_path):
    api = DataAPI(spark, str(tmp_path))
    rows = [("A", "2024-01-01", "1.5"), ("A", "2024-01-02", "x1"), ("B", "2024-01-01", "N/A"), ("B", "2024-01-02", None)]
    frame = spark.createDataFrame(rows, "series_code string, timestamp string, value string")
    with pytest.warns(UserWarning, match="2 value"):
        api.write_values(frame)
    assert api.lost_values[0] == 2 and set(api.lost_values[1]) <= {"x1", "N/A"}
    wide = spark.createDataFrame([("2024-01-03", "7", "bad")], "timestamp string, A string, B string")
    with pytest.warns(UserWarning, match="1 value"):
        api.write_values(wide.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))
    assert api.values_frame().filter("value IS NOT NULL").count() == 2


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_wide_writes_keep_the_latest_time_of_a_day(spark, tmp_path, parts):
    api = DataAPI(spark, str(tmp_path))
    rows = [("2024-01-01 17:00:00", 5.0, None), ("2024-01-01 09:00:00", 1.0, 2.0), ("2024-01-02 09:00:00", 3.0, None)]
    wide = spark.createDataFrame(rows, "timestamp string, A double, B double")
    api.write_values(wide.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).repartition(parts), ticker_source="BBG")
    assert records(api.values_frame(), "series_code", "value") == [("A", 3.0), ("A", 5.0), ("B", 2.0)]


def test_save_order_decides_within_a_write(spark, tmp_path):
    api = DataAPI(spark, str(tmp_path))
    rows = [("A", "2024-01-01", float(k), 100 - k) for k in range(6)]
    frame = spark.createDataFrame(rows, "series_code string, timestamp string, value double, saved int")
    api.write_values(frame.repartition(4), save_order="saved")
    assert api.get_values(["A"]).first()["A"] == 0.0
    api.write_values(frame.filter("value = 4"), save_order="saved")
    assert api.get_values(["A"]).first()["A"] == 4.0


def test_unknown_filter_values_are_named(spark, tmp_path):
    api = DataAPI(spark, str(tmp_path))
    api.import_metadata(spark.createDataFrame([("A", "Equity")], "series_code string, asset_class string"))
    with pytest.warns(UserWarning, match="Bond"):
        assert api.get_metadata(asset_class=["Equity", "Bond"]).count() == 1


def test_replaced_runs(spark, tmp_path):
    api = DataAPI(spark, str(tmp_path))
    schema = "universe string, day int, v int"
    first = spark.createDataFrame([("G10", 1, 1), ("G10", 1, 2), ("EM", 1, 3)], schema)
    api.write_table("gold", "t", first, replace=["universe", "day"])
    api.write_table("gold", "t", spark.createDataFrame([("G10", 1, 9), ("G10", 2, 4)], schema), replace=["universe", "day"])
    assert records(api.read_table("gold", "t").frame) == [("EM", 1, 3), ("G10", 1, 9), ("G10", 2, 4)]
