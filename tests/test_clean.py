from datetime import datetime

import pytest

from sensorloom.operators.clean import clean_item, clean_measure, clean_station
from sensorloom.operators.dedup import first_per_key
from sensorloom.operators.quality import clean_report, detect_errors, error_counts

SCHEMA = (
    "Measurement_Date timestamp, Station_Code int, Item_Code int, Average_Value double, "
    "Instrument_Status int"
)
T = datetime(2020, 1, 1, 5)
NAN = float("nan")
ROWS = [
    (T, 1, 1, 5.0, 0),
    (T, 1, 1, 4.0, 1),
    (T, 1, 1, 4.0, None),
    (T, 1, 2, NAN, 0),
    (T, 2, 1, -1.0, 0),
    (T, 0, 1, 1.0, 0),
    (T, 1, 0, 1.0, 0),
    (T, None, 1, 1.0, 0),
    (T, 1, None, 1.0, 0),
    (T, 1, 1, None, 0),
    (None, 1, 1, -1.0, 0),
    (T, 3, 1, 0.0, 9),
    (T, 3, 1, 0.0, 0),
]


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_clean_measure_keeps_the_lowest_valid_reading(raw):
    assert sorted(clean_measure(raw).collect()) == [(T, 1, 1, 4.0, 1), (T, 3, 1, 0.0, 0)]


def test_instrument_status_filter_is_optional(raw):
    cleaned = clean_measure(raw, bad_statuses=None)
    assert sorted(cleaned.select("Station_Code", "Instrument_Status").collect(), key=str) == [
        (1, None),
        (3, 0),
    ]


def test_cleaning_twice_changes_nothing(raw):
    once = clean_measure(raw)
    assert sorted(clean_measure(once).collect()) == sorted(once.collect())


def test_survivor_does_not_depend_on_partitions(raw):
    few, many = clean_measure(raw.coalesce(1)), clean_measure(raw.repartition(7))
    assert sorted(few.collect()) == sorted(many.collect())


def test_text_dates_are_parsed_strictly(spark):
    schema = SCHEMA.replace("timestamp", "string")
    df = spark.createDataFrame(
        [(" 2020-01-01 05:00 ", 1, 1, 1.0, 0), ("bad", 1, 1, 1.0, 0)], schema
    )
    assert clean_measure(df).collect() == [(T, 1, 1, 1.0, 0)]
    bad = spark.createDataFrame([("bad", 1, 1, -1.0, 0)], schema)
    assert detect_errors(bad).first()["Removal_Reason"] == "Bad date"


def test_error_reasons_and_their_priority(raw):
    found = [r["Removal_Reason"] for r in detect_errors(raw).collect()]
    assert sorted(found) == sorted(
        ["Negative average", "Bad date", "Unreliable data"]
        + ["Invalid codes"] * 2
        + ["Missing values"] * 3
    )
    counts = error_counts(detect_errors(raw)).collect()
    assert [tuple(r) for r in counts] == [
        ("Missing values", 3),
        ("Invalid codes", 2),
        ("Bad date", 1),
        ("Negative average", 1),
        ("Unreliable data", 1),
    ]


def test_report_accounts_for_every_row(spark, raw):
    station = spark.createDataFrame(
        [(1, "a", 1.0, 1.0), (1, "b", 1.0, 1.0), (2, None, 1.0, 1.0)],
        "Station_Code int, Station_Name string, Latitude double, Longitude double",
    )
    item = spark.createDataFrame(
        [(1, "a", "u")], "Item_Code int, Item_Name string, Unit string"
    )
    lines = {(r["Table"], r["Outcome"]): r["Rows"] for r in clean_report(raw, station, item).collect()}
    measured = {k[1]: v for k, v in lines.items() if k[0] == "measurement"}
    assert measured.pop("Raw") == len(ROWS) == sum(measured.values())
    assert measured["Clean"] == clean_measure(raw).count() == 2
    assert measured["Duplicates"] == 1
    assert measured["NaN value"] == 1
    assert measured["NULL instrument status"] == 1
    assert lines["station", "Raw"] == 3 and lines["station", "Clean"] == 1
    assert lines["item", "Raw"] == lines["item", "Clean"] == 1


def test_report_of_empty_tables(spark, raw):
    empty = clean_report(
        raw.limit(0),
        spark.createDataFrame(
            [], "Station_Code int, Station_Name string, Latitude double, Longitude double"
        ),
        spark.createDataFrame([], "Item_Code int, Item_Name string, Unit string"),
    )
    assert all(r["Rows"] == 0 for r in empty.collect())


def test_clean_station(spark):
    df = spark.createDataFrame(
        [
            (1, " b ", 90.0, -180.0, "x"),
            (1, "a", 0.0, 0.0, "y"),
            (2, "c", 90.1, 0.0, None),
            (3, "d", 0.0, 180.1, None),
            (4, None, 0.0, 0.0, None),
            (5, "e", float("nan"), 0.0, None),
            (None, "f", 0.0, 0.0, None),
        ],
        "Station_Code int, Station_Name string, Latitude double, Longitude double, Address string",
    )
    assert clean_station(df).collect() == [(1, "a", 0.0, 0.0, "y")]


def test_clean_item(spark):
    df = spark.createDataFrame(
        [(1, " a", "u ", 1.0), (1, "b", "u", 2.0), (2, None, "u", 1.0), (3, "c", None, 1.0)],
        "Item_Code int, Item_Name string, Unit string, `Good(Blue)` double",
    )
    assert clean_item(df).collect() == [(1, "a", "u", 1.0)]


def test_first_per_key_orders_and_directions(spark):
    df = spark.createDataFrame(
        [(1, 2, "x"), (1, 1, "z"), (1, 1, "y"), (None, 3, "n")], "k int, o int, v string"
    )
    first = first_per_key(df, ["k"], order=["o"]).collect()
    last = first_per_key(df, ["k"], order=["o"], last=True).collect()
    assert sorted(first, key=str) == sorted([(1, 1, "y"), (None, 3, "n")], key=str)
    assert sorted(last, key=str) == sorted([(1, 2, "x"), (None, 3, "n")], key=str)
    assert first_per_key(df.select("k"), ["k"]).count() == 2


def test_report_adds_up_for_padded_times_and_one_shot_statuses(spark):
    rows = [(" 2017-01-01 00:00 ", 1, 1, 1.0, 0), ("2017-01-01 01:00", 1, 1, 2.0, 4), ("x", 1, 1, 3.0, 0)]
    raw = spark.createDataFrame(
        rows,
        "Measurement_Date string, Station_Code int, Item_Code int, Average_Value double, Instrument_Status int",
    )
    once = (status for status in (2, 4, 8, 9))
    clean = clean_measure(raw, bad_statuses=once).count()
    stations = spark.createDataFrame([], "Station_Code int, Station_Name string, Latitude double, Longitude double")
    items = spark.createDataFrame([], "Item_Code int, Item_Name string, Unit string")
    report = clean_report(raw, stations, items, bad_statuses=(s for s in (2, 4, 8, 9)))
    lines = {r["Outcome"]: r["Rows"] for r in report.filter("Table = 'measurement'").collect()}
    assert lines["Clean"] == clean == 1
    assert lines.pop("Raw") == sum(lines.values()) == 3
    assert detect_errors(raw, bad_statuses=(s for s in (4,))).count() == 3
