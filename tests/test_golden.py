"""Counts worked out beforehand on another mapping of the tables, with injected faults."""

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import documents, graph, quality, reports
from sensorloom.operators.clean import clean_item, clean_measure, clean_station
from sensorloom.operators.enrich import enrich_measure

EXPECTED = {
    "0.001": {
        "raw": 1015,
        "errors": {
            "Unreliable data": 361, "Invalid codes": 16, "Negative average": 12,
            "Missing values": 11, "Bad date": 12,
        },
        "clean": 575,
        "stations": (144, 131),
        "grades": {"Good": 148, "Normal": 135, "Bad": 102, "Very Bad": 190},
        "missing": (116, 34),
        "orphans": (1, 1),
        "snapshot": 75,
        "hot_spots": 75,
        "daily": 504,
        "item_status": 17,
        "rules": [15, 23, 90, 204, 3, 1, 14, 378, 0],
    },
    "0.01": {
        "raw": 10141,
        "errors": {
            "Unreliable data": 3797, "Invalid codes": 162, "Negative average": 119,
            "Missing values": 112, "Bad date": 106,
        },
        "clean": 5551,
        "stations": (1448, 1298),
        "grades": {"Good": 1495, "Normal": 1318, "Bad": 972, "Very Bad": 1766},
        "missing": (1134, 608),
        "orphans": (17, 1),
        "snapshot": 749,
        "hot_spots": 749,
        "daily": 4523,
        "item_status": 17,
        "rules": [146, 218, 658, 2042, 8, 1, 123, 4001, 687],
    },
}


def inputs(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    base = spark.read.parquet(f"{folder}/events.parquet").selectExpr(
        "event_id",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(ts AS timestamp) END AS Measurement_Date",
        "CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 61 = 0 THEN 0 ELSE user_id + 1 END"
        " AS Station_Code",
        "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 3 WHEN 'purchase' THEN 5"
        " WHEN 'signup' THEN 6 ELSE 8 END AS Item_Code",
        "CASE WHEN event_id % 83 = 0 THEN -value WHEN event_id % 79 = 0 THEN double('NaN')"
        " ELSE value END AS Average_Value",
        "CASE WHEN event_id % 73 = 0 THEN NULL"
        " ELSE int(get_json_object(props, '$.k')) % 10 END AS Instrument_Status",
    )
    raw = base.union(base.filter("event_id % 71 = 0")).drop("event_id")
    station = spark.read.parquet(f"{folder}/customer.parquet").filter("c_custkey % 29 <> 0").selectExpr(
        "c_custkey + 1 AS Station_Code",
        "c_name AS Station_Name",
        "c_acctbal / 100 AS Latitude",
        "c_acctbal / 50 AS Longitude",
    )
    item = spark.createDataFrame(
        [
            (1, "click", "u", 25.0, 50.0, 100.0),
            (3, "view", "u", 20.0, 40.0, 80.0),
            (5, "purchase", "u", 30.0, 60.0, 120.0),
            (6, "signup", "u", 10.0, 50.0, 90.0),
        ],
        "Item_Code int, Item_Name string, Unit string, `Good(Blue)` double, "
        "`Normal(Green)` double, `Bad(Yellow)` double",
    )
    return raw, station, item


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_counts(spark, sf):
    expected = EXPECTED[sf]
    raw, station_raw, item_raw = inputs(spark, sf)
    measure, station, item = clean_measure(raw), clean_station(station_raw), clean_item(item_raw)
    enriched = enrich_measure(measure, station, item).cache()
    errors = quality.error_counts(quality.detect_errors(raw))

    assert raw.count() == expected["raw"]
    assert {r[0]: r[1] for r in errors.collect()} == expected["errors"]
    assert measure.count() == expected["clean"]
    assert (station_raw.count(), station.count()) == expected["stations"]
    assert {r[0]: r[1] for r in enriched.groupBy("Status").count().collect()} == expected["grades"]

    cleaned = {r[0]: r[1] for r in quality.validation_summary(enriched, station, item).collect()}
    assert (cleaned["Missing_Item_Info"], cleaned["Missing_Station_Info"]) == expected["missing"]
    assert (cleaned["Orphan_Station"], cleaned["Orphan_Item"]) == expected["orphans"]
    assert cleaned["Duplicates"] == cleaned["Nulls"] == cleaned["Negative_Values"] == 0

    docs = documents.measurement_documents(enriched, "bigint")
    items = item.select(F.col("Item_Code").alias("_id"), F.col("Item_Name").alias("name"))
    stations = station.select(F.col("Station_Code").alias("_id"), F.col("Station_Name").alias("name"))
    assert documents.latest_snapshot(docs, items, stations).count() == expected["snapshot"]

    vertices = graph.build_graph(enriched)
    assert graph.hot_spots(vertices).count() == expected["hot_spots"]
    assert graph.daily_avg(vertices).count() == expected["daily"]
    assert reports.item_status_stats(enriched).count() == expected["item_status"]

    uncleaned = enrich_measure(raw, station_raw, item_raw)
    rules = quality.validation_summary(uncleaned, station_raw, item_raw)
    assert [r["Validations"] for r in rules.collect()] == expected["rules"]

    report = {
        r["Outcome"]: r["Rows"]
        for r in quality.clean_report(raw, station_raw, item_raw).collect()
        if r["Table"] == "measurement"
    }
    assert report.pop("Raw") == sum(report.values()) == expected["raw"]
    assert report["Clean"] == expected["clean"]
    enriched.unpersist()
