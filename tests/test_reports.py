from datetime import datetime

import pytest

from sensorloom.operators.reports import (
    bad_records,
    bad_records_hourly,
    item_status_pretty,
    item_status_stats,
    zero_values,
)

T = datetime(2020, 1, 1, 5, 40)
SCHEMA = (
    "Measurement_Date timestamp, Item_Code int, Item_Name string, Station_Name string, "
    "Average_Value double, Status string"
)


@pytest.fixture(scope="module")
def enriched(spark):
    return spark.createDataFrame(
        [
            (T, 1, "SO2", "A", 1.0, "Good"),
            (T, 1, "SO2", "A", 2.0, "Good"),
            (T, 1, "SO2", "A", 9.0, "Very Bad"),
            (T, 1, "SO2", "B", 5.0, "Bad"),
            (T, 1, "SO2", "B", None, "Bad"),
            (T, 3, "CO", "B", 0.0, "Other"),
            (T, 9, None, "B", 7.0, "Very Bad"),
        ],
        SCHEMA,
    )


def test_item_status_stats(enriched):
    found = {(r["Item_Name"], r["Status"]): tuple(r)[2:] for r in item_status_stats(enriched).collect()}
    assert found == {
        ("SO2", "Good"): (2, 1.5, 1.0, 2.0),
        ("SO2", "Bad"): (1, 5.0, 5.0, 5.0),
        ("SO2", "Very Bad"): (1, 9.0, 9.0, 9.0),
        ("CO", "Other"): (1, 0.0, 0.0, 0.0),
        (None, "Very Bad"): (1, 7.0, 7.0, 7.0),
    }


def test_item_status_pretty(enriched):
    lines = item_status_pretty(item_status_stats(enriched)).collect()
    assert [(r["Item"], r["Status"]) for r in lines] == [
        (None, "Very Bad"),
        ("CO", "Other"),
        ("SO2", "Good"),
        ("", "Bad"),
        ("", "Very Bad"),
    ]


def test_bad_records_are_exactly_bad(enriched):
    assert sorted(r["Value"] or 0 for r in bad_records(enriched).collect()) == [0, 5.0]
    assert {r["Hour"] for r in bad_records_hourly(enriched).collect()} == {datetime(2020, 1, 1, 5)}


def test_bad_records_parse_text_times(spark):
    df = spark.createDataFrame(
        [("2020-01-01 05:40", 1, "SO2", "A", 1.0, "Bad"), ("bad", 1, "SO2", "A", 1.0, "Bad")],
        SCHEMA.replace("timestamp", "string"),
    )
    assert [r["Measurement_Date"] for r in bad_records(df).collect()] == [T, None]


def test_zero_values(enriched):
    assert [r["Item_Code"] for r in zero_values(enriched).collect()] == [3]
