import os
from datetime import datetime

import pytest

from sensorloom.operators.documents import (
    historical_trend,
    history_head,
    insert_counts,
    insert_ignore,
    item_documents,
    latest_snapshot,
    latest_snapshot_report,
    measurement_documents,
    station_documents,
)
from sensorloom.sources.documents import (
    LoadCounts,
    load_collection,
    load_measurements,
    read_collection,
)

T1, T2 = datetime(2020, 1, 1, 5), datetime(2020, 1, 2, 6)


@pytest.fixture(scope="module")
def items(spark):
    source = spark.createDataFrame(
        [("1", "SO2", "ppm", "0.02", "0.05", None, "x"), ("3.0", "NO2", "ppm", "1", "2", "3", "4"),
         (None, "none", "ppm", "1", "2", "3", "4")],
        "`Item code` string, `Item name` string, `Unit of measurement` string, `Good(Blue)` string, "
        "`Normal(Green)` string, `Bad(Yellow)` string, `Very bad(Red)` string",
    )
    return item_documents(source)


@pytest.fixture(scope="module")
def stations(spark):
    source = spark.createDataFrame(
        [(101, "A", "street 1", 37.5, 127.0), (102, "B", None, None, 127.0), (None, "C", None, 1.0, 1.0)],
        "`Station code` int, `Station name(district)` string, Address string, Latitude double, Longitude double",
    )
    return station_documents(source)


@pytest.fixture(scope="module")
def measurements(spark):
    enriched = spark.createDataFrame(
        [
            (T1, 101, 1, 1.0, 0, "Good"),
            (T2, 101, 1, 2.0, 0, "Bad"),
            (T2, 101, 1, 3.0, 0, "Bad"),
            (T1, 102, 3, 5.0, None, "Good"),
            (T1, 999, 8, 7.0, 0, None),
            (None, 101, 1, 9.0, 0, "Bad"),
        ],
        "Measurement_Date timestamp, Station_Code int, Item_Code int, Average_Value double, "
        "Instrument_Status int, Status string",
    )
    return measurement_documents(enriched)


def test_item_documents(items):
    rows = {r["_id"]: r for r in items.collect()}
    assert set(rows) == {1, 3}
    assert rows[1]["thresholds"].asDict() == {
        "good": 0.02, "normal": 0.05, "bad": None, "very_bad": None,
    }


def test_station_documents(stations):
    rows = {r["_id"]: r for r in stations.collect()}
    assert set(rows) == {101, 102}
    assert rows[101]["location"].asDict() == {"type": "Point", "coordinates": [127.0, 37.5]}
    assert rows[102]["location"] is None


def test_measurement_documents(measurements):
    assert measurements.count() == 5
    assert measurements.columns == ["ts", "avg", "instrument_status", "status", "meta"]
    assert measurements.filter("meta.station_code = 102").first()["meta"].asDict() == {
        "station_code": 102, "item_code": 3,
    }


def test_latest_snapshot(measurements, items, stations):
    snapshot = latest_snapshot(measurements, items, stations)
    rows = {(r["Station Code"], r["Item Code"]): r for r in snapshot.collect()}
    assert tuple(rows[101, 1]) == ("2020-01-02 06:00", 101, "A", 1, "SO2", 3.0, "Bad")
    assert tuple(rows[999, 8]) == ("2020-01-01 05:00", 999, None, 8, None, 7.0, None)
    assert len(rows) == 3
    report = latest_snapshot_report(snapshot).collect()
    assert [r["Item Name"] for r in report] == ["NO2", "SO2"]


def test_duplicate_lookup_documents_add_no_rows(measurements, items, stations):
    assert latest_snapshot(measurements, items.union(items), stations.union(stations)).count() == 3


def test_history(measurements, items, stations):
    history = historical_trend(measurements, items, stations, 1, 101)
    assert [tuple(r) for r in history.collect()] == [
        ("2020-01-01 05:00", "A", "SO2", 1.0, "Good"),
        ("2020-01-02 06:00", "A", "SO2", 2.0, "Bad"),
    ]
    assert [r["Datetime"] for r in history_head(history, 1).collect()] == [T1]
    unknown = historical_trend(measurements, items, stations, 8, 999).collect()
    assert [tuple(r) for r in unknown] == [("2020-01-01 05:00", None, None, 7.0, None)]
    assert historical_trend(measurements, items, stations, 5, 5).count() == 0


def test_unreadable_history_time_becomes_null(spark):
    history = spark.createDataFrame(
        [("2020-01-01 05:00", 1.0, "Good"), ("soon", 2.0, "Bad")],
        "Datetime string, Value double, Status string",
    )
    assert [r["Datetime"] for r in history_head(history).collect()] == [None, T1]


def test_insert_ignore_keeps_the_first_and_skips_known(spark):
    incoming = spark.createDataFrame(
        [(1, 2, "b"), (1, 1, "a"), (2, 3, "c"), (3, 4, "d")], "_id int, seq int, name string"
    )
    existing = spark.createDataFrame([(3, "old")], "_id int, name string")
    assert sorted(insert_ignore(incoming, existing, order=["seq"]).collect()) == [(1, 1, "a"), (2, 3, "c")]
    assert insert_counts(incoming, existing).collect() == [(4, 2, 2)]
    assert insert_counts(incoming).collect() == [(4, 3, 1)]
    assert insert_counts(incoming.limit(0), existing).collect() == [(0, 0, 0)]


def test_load_replaces_or_adds(spark, items, tmp_path):
    path = str(tmp_path / "items")
    assert read_collection(spark, path) is None
    assert load_collection(items, path, drop_existing=False) == LoadCounts(2, 2)
    assert load_collection(items.union(items), path, drop_existing=False) == LoadCounts(4, 0)
    assert load_collection(items.union(items), path) == LoadCounts(4, 2)
    assert read_collection(spark, path).count() == 2
    assert load_collection(items, path, drop_existing=False, key=None) == LoadCounts(2, 2)
    assert read_collection(spark, path).count() == 4


def test_first_in_load_order_stays(spark, tmp_path):
    rows = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (2, "z", 3)], "_id int, name string, seq int")
    path = str(tmp_path / "ordered")
    assert load_collection(rows, path, order=["seq"]) == LoadCounts(3, 2)
    assert {r["_id"]: r["name"] for r in read_collection(spark, path).collect()} == {1: "b", 2: "z"}


def test_measurements_are_added_once(spark, measurements, tmp_path):
    path = str(tmp_path / "once")
    some = measurements.limit(2)
    first = load_measurements(some, path, period="month", distinct=True)
    assert first.attempted == 2
    both = measurements.union(measurements)
    second = load_measurements(both, path, period="month", distinct=True)
    stored = read_collection(spark, path)
    keys = stored.select("ts", "meta").distinct().count()
    assert second.attempted == 10 and first.inserted + second.inserted == stored.count() == keys
    assert load_measurements(both, path, period="month", distinct=True).inserted == 0


def test_measurements_are_appended_by_day(
    spark, measurements, items, stations, tmp_path, capsys
):
    path = str(tmp_path / "measurements")
    assert load_measurements(measurements, path) == LoadCounts(5, 5)
    load_measurements(measurements, path)
    stored = read_collection(spark, path)
    assert stored.count() == 10
    assert {p.name for p in (tmp_path / "measurements").glob("day=*")} == {
        "day=2020-01-01", "day=2020-01-02",
    }
    # A rerun repeats rows; the history is free of them.
    history = historical_trend(stored, items, stations, 1, 101)
    assert history.count() == 2
    history.explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(meta.item_code,1)" in plan and "EqualTo(meta.station_code,101)" in plan


def test_distinct_load_computes_its_documents_once(spark, tmp_path):
    """The incoming documents are counted while they are reduced, also where all are stored or none
    come, and nothing but the collection is left."""
    path, seen = str(tmp_path / "m"), spark.sparkContext.accumulator(0)

    def touched(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(datetime(2020, 1, d % 20 + 1), float(d), 0, "Good", (d % 3, 1)) for d in range(90)]
    schema = (
        "ts timestamp, avg double, instrument_status int, status string, "
        "meta struct<station_code: int, item_code: int>"
    )
    documents = spark.createDataFrame(rows, schema)
    offered = documents.mapInArrow(touched, documents.schema)
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = os.listdir(shared)
    for expected in ((90, 60), (90, 0)):
        seen.value = 0
        counts = load_measurements(offered, path, period="month", distinct=True)
        assert (counts.attempted, counts.inserted, seen.value) == (*expected, 90)
    none = load_measurements(offered.filter("avg < 0"), path, period="month", distinct=True)
    assert (none.attempted, none.inserted) == (0, 0)
    assert sorted(os.listdir(shared)) == sorted(before)
