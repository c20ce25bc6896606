"""The operators against plain Python loops on random rows full of faults and ties."""

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import documents, graph, quality
from sensorloom.operators.clean import clean_measure
from sensorloom.operators.enrich import enrich_measure

START = datetime(2021, 3, 1)
NAMES = ["date", "station", "item", "value", "state"]
STATIONS = {1: "north", 2: "south", 3: "north"}
ITEMS = {1: ("SO2", 2.0, 4.0, 6.0), 2: ("CO", 1.0, 2.0, 3.0), 3: ("SO2", 5.0, 6.0, 7.0)}


def random_rows(seed, n=600):
    rng = random.Random(seed)
    values = [None, math.nan, -1.0, 0.0, 0.5, 2.0, 2.5, 4.0, 6.0, 9.0]
    return [
        (
            rng.choice([None, *[START + timedelta(hours=h) for h in range(0, 60, 7)]]),
            rng.choice([None, -1, 0, 1, 2, 3, 9]),
            rng.choice([None, -1, 0, 1, 2, 3, 9]),
            rng.choice(values),
            rng.choice([None, 0, 0, 0, 1, 2, 4, 8, 9]),
        )
        for _ in range(n)
    ]


def reason(row):
    date, station, item, value, state = row
    if date is None:
        return "Bad date"
    if station is None or item is None or value is None:
        return "Missing values"
    if value < 0:
        return "Negative average"
    if station <= 0 or item <= 0:
        return "Invalid codes"
    if state in (2, 4, 8, 9):
        return "Unreliable data"
    if math.isnan(value):
        return "NaN value"
    if state is None:
        return "NULL instrument status"
    return None


def cleaned(rows):
    best = {}
    for row in rows:
        if reason(row) is None:
            key, payload = row[:3], row[3:]
            best[key] = min(best.get(key, payload), payload)
    return {key + payload for key, payload in best.items()}


def status(item, value):
    if item not in ITEMS:
        return "Very Bad"
    for bound, label in zip(ITEMS[item][1:], ("Good", "Normal", "Bad")):
        if value <= bound:
            return label
    return "Very Bad"


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    rows = random_rows(request.param)
    raw = spark.createDataFrame(
        rows,
        "Measurement_Date timestamp, Station_Code int, Item_Code int, Average_Value double, "
        "Instrument_Status int",
    ).repartition(5)
    station = spark.createDataFrame(
        [(code, name, 1.0, 2.0) for code, name in STATIONS.items()],
        "Station_Code int, Station_Name string, Latitude double, Longitude double",
    )
    item = spark.createDataFrame(
        [(code, name, "u", *bounds) for code, (name, *bounds) in ITEMS.items()],
        "Item_Code int, Item_Name string, Unit string, `Good(Blue)` double, "
        "`Normal(Green)` double, `Bad(Yellow)` double",
    )
    return rows, raw, station, item


def test_clean(case):
    rows, raw, _, _ = case
    assert {tuple(r) for r in clean_measure(raw).collect()} == cleaned(rows)


def test_reasons(case):
    rows, raw, station, item = case
    expected = defaultdict(int)
    for row in rows:
        expected[reason(row)] += 1
    kept = expected.pop(None)
    report = {
        r["Outcome"]: r["Rows"]
        for r in quality.clean_report(raw, station, item).collect()
        if r["Table"] == "measurement"
    }
    clean = len(cleaned(rows))
    assert report == {
        **expected, "Raw": len(rows), "Clean": clean, "Duplicates": kept - clean,
    }
    unlisted = ("NaN value", "NULL instrument status")
    counts = {r[0]: r[1] for r in quality.error_counts(quality.detect_errors(raw)).collect()}
    assert counts == {k: v for k, v in expected.items() if k not in unlisted}


@pytest.mark.parametrize("limits", [{}, {"max_rows": 2, "hot_rows": 20}])
def test_enrich(case, limits):
    rows, raw, station, item = case
    out = enrich_measure(clean_measure(raw), station, item, **limits)
    found = {
        (r["Measurement_Date"], r["Station_Code"], r["Item_Code"], r["Station_Name"],
         r["Item_Name"], r["Status"])
        for r in out.collect()
    }
    assert found == {
        (d, s, i, STATIONS.get(s), ITEMS.get(i, [None])[0], status(i, v))
        for d, s, i, v, _ in cleaned(rows)
    }


def test_latest(case):
    rows, raw, station, item = case
    docs = documents.measurement_documents(
        enrich_measure(clean_measure(raw), station, item)
    )
    items = item.select(F.col("Item_Code").alias("_id"), F.col("Item_Name").alias("name"))
    stations = station.select(
        F.col("Station_Code").alias("_id"), F.col("Station_Name").alias("name")
    )
    latest = {}
    for d, s, i, v, _ in cleaned(rows):
        latest[s, i] = max(latest.get((s, i), (d, v)), (d, v))
    found = documents.latest_snapshot(docs, items, stations).collect()
    assert {
        (r["Station Code"], r["Item Code"]): (r["Datetime"], r["Value"]) for r in found
    } == {k: (d.strftime("%Y-%m-%d %H:%M"), v) for k, (d, v) in latest.items()}


def test_graph_queries(case):
    rows, raw, station, item = case
    built = graph.build_graph(enrich_measure(clean_measure(raw), station, item))
    pairs, days = defaultdict(list), defaultdict(list)
    for d, s, i, v, _ in cleaned(rows):
        names = (STATIONS.get(s), ITEMS.get(i, [None])[0])
        pairs[(s, i), names].append((v, status(i, v)))
        days[(d.date(), *names)].append(v)

    def two(x):
        return math.floor(x * 100 + 0.5) / 100

    expected = sorted(
        (
            (*names, sum("Bad" in st for _, st in got), len(got),
             two(100.0 * sum("Bad" in st for _, st in got) / len(got)),
             two(sum(v for v, _ in got) / len(got)), max(v for v, _ in got))
            for (_, names), got in pairs.items()
        ),
        key=str,
    )
    assert sorted((tuple(r) for r in graph.hot_spots(built).collect()), key=str) == expected
    found = {tuple(r)[:3]: r["Daily_Avg_Value"] for r in graph.daily_avg(built).collect()}
    assert found == {key: two(sum(vs) / len(vs)) for key, vs in days.items()}


def test_validation(case):
    rows, raw, station, item = case
    enriched = enrich_measure(raw, station, item)
    keys = defaultdict(int)
    for row in rows:
        keys[row[:3]] += 1
    summary = quality.validation_summary(enriched, station, item).collect()
    assert {r["Rule_ID"]: r["Validations"] for r in summary} == {
        "Duplicates": sum(n > 1 for n in keys.values()),
        "Nulls": sum(None in row[:4] for row in rows),
        "Missing_Station_Info": sum(row[1] not in STATIONS for row in rows),
        "Missing_Item_Info": sum(row[2] not in ITEMS for row in rows),
        "Orphan_Station": len({row[1] for row in rows} - set(STATIONS)),
        "Orphan_Item": len({row[2] for row in rows} - set(ITEMS)),
        "Negative_Values": sum(row[3] is not None and row[3] < 0 for row in rows),
        "Bad_Status": sum(row[4] in (2, 4, 8, 9) for row in rows),
        "Bad_Latitude_Longitude": 0,
    }
