from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sensorloom.operators.graph import (
    EDGES,
    MEASUREMENT_ID,
    build_graph,
    daily_avg,
    edge_rows,
    edge_tables,
    hot_spots,
    key_audit,
    match_paths,
    vertex_rows,
)
from sensorloom.schemas import ENRICHED

T1, T2 = datetime(2020, 1, 1, 5), datetime(2020, 1, 1, 6)


def row(item, station, time, value, status, name="A", item_name="SO2", latitude=1.0):
    return (item, station, time, value, 0, name, latitude, 2.0, "x", item_name, "u", status)


ROWS = [
    row(1, 1, T1, 1.0, "Good"),
    row(1, 1, T2, 4.0, "Bad", name="A renamed"),
    row(1, 2, T1, 9.0, "Very Bad"),
    row(2, 1, T1, 2.0, "Good", item_name=None),
    row(3, 1, T1, 4.0, "Good", item_name=None),
    row(1, 9, T1, 3.0, "Normal", name=None, latitude=None),
    row(1, None, T1, 3.0, "Normal"),
    row(1, 1, None, 3.0, "Normal"),
    row(1, 1, T1, 3.0, None),
]


@pytest.fixture(scope="module")
def graph(spark):
    return build_graph(spark.createDataFrame(ROWS, ENRICHED))


def test_vertices(graph):
    stations = {r["Station_Code"]: r for r in graph.station.collect()}
    assert set(stations) == {1, 2, 9}
    assert stations[1]["Name"] == "A"  # the first write wins
    assert stations[9]["Name"] is None
    assert {r["Item_Code"] for r in graph.item.collect()} == {1, 2, 3}
    assert {r["Level"] for r in graph.status.collect()} == {"Good", "Normal", "Bad", "Very Bad"}
    assert {r["Raw_Datetime"] for r in graph.time.collect()} == {T1, T2}
    assert graph.measurement.count() == 6
    assert graph.rejected.count() == 3
    assert vertex_rows(graph).groupBy("Label").count().count() == 5


def test_last_write_of_a_measurement_wins(spark):
    rows = [(*row(1, 1, T1, 5.0, "Bad"), 1), (*row(1, 1, T1, 1.0, "Good"), 2)]
    df = spark.createDataFrame(rows, StructType([*ENRICHED.fields, StructField("seq", LongType())]))
    merged = build_graph(df, seq="seq")
    assert [(r["Value"], r["Status"]) for r in merged.measurement.collect()] == [(1.0, "Good")]
    levels = edge_rows(merged).filter("Type = 'HAS_STATUS'").select("Level").collect()
    assert levels == [("Good",)]
    # Without a write order the higher reading wins.
    unordered = build_graph(df.drop("seq"))
    assert [r["Value"] for r in unordered.measurement.collect()] == [5.0]


def test_edges_refer_to_vertices(graph):
    edges = edge_rows(graph)
    assert edges.count() == 4 * graph.measurement.count()
    assert edges.distinct().count() == edges.count()
    assert {(r["Type"], r["From"], r["To"]) for r in edges.collect()} == set(EDGES)
    ends = {
        "HAS_MEASUREMENT": graph.station.select("Station_Code"),
        "MEASURED_IN": graph.item.select("Item_Code"),
        "AT_TIME": graph.time.select("Raw_Datetime"),
        "HAS_STATUS": graph.status.select("Level"),
    }
    for kind, table in edge_tables(graph).items():
        other = ends[kind].toDF("Other")
        assert table.join(other, "Other", "left_anti").count() == 0
        assert table.count() == graph.measurement.count()


def test_paths_equal_the_joins_over_edge_tables(graph):
    edges = edge_tables(graph)
    has = edges["HAS_MEASUREMENT"].withColumnRenamed("Other", "s")
    measured = edges["MEASURED_IN"].withColumnRenamed("Other", "i")
    joined = (
        graph.measurement.join(has, MEASUREMENT_ID)
        .join(measured, MEASUREMENT_ID)
        .join(graph.station.select(F.col("Station_Code").alias("s"), F.col("Name").alias("Station")), "s")
        .join(graph.item.select(F.col("Item_Code").alias("i"), F.col("Name").alias("Pollutant")), "i")
    )
    columns = [*MEASUREMENT_ID, "Value", "Status", "Station", "Pollutant"]
    found = match_paths(graph).select(columns).collect()
    assert sorted(found, key=str) == sorted(joined.select(columns).collect(), key=str)


def test_hot_spots(graph):
    found = [tuple(r) for r in hot_spots(graph).collect()]
    assert found == [
        ("A", "SO2", 1, 1, 100.0, 9.0, 9.0),
        ("A", "SO2", 1, 2, 50.0, 2.5, 4.0),
        ("A", None, 0, 1, 0.0, 4.0, 4.0),
        (None, "SO2", 0, 1, 0.0, 3.0, 3.0),
        ("A", None, 0, 1, 0.0, 2.0, 2.0),
    ]


def test_null_sorts_first_in_hot_spots(spark):
    df = spark.createDataFrame(
        [row(1, 1, T1, None, "Good"), row(1, 2, T1, 1.0, "Good")], ENRICHED
    )
    assert [r["Avg_Value"] for r in hot_spots(build_graph(df)).collect()] == [None, 1.0]


def test_daily_average_groups_by_name(graph):
    found = {(r["Day"], r["Station"], r["Pollutant"]): r["Daily_Avg_Value"] for r in daily_avg(graph).collect()}
    day = date(2020, 1, 1)
    assert found == {
        (day, "A", "SO2"): 4.67,  # stations 1 and 2 share a name
        (day, "A", None): 3.0,  # unnamed items fall together
        (day, None, "SO2"): 3.0,
    }


def test_stored_properties_give_the_same_graph(spark, graph, tmp_path):
    stored = build_graph(spark.createDataFrame(ROWS, ENRICHED), folder=str(tmp_path / "v"))
    for table in ("station", "item", "status"):
        assert sorted(getattr(stored, table).collect(), key=str) == sorted(
            getattr(graph, table).collect(), key=str
        )
    assert hot_spots(stored).collect() == hot_spots(graph).collect()


def test_properties_may_come_from_another_table(spark, graph):
    df = spark.createDataFrame(ROWS, ENRICHED)
    keys = ["Station_Code", "Item_Code", "Status", "Measurement_Date"]
    described = df.na.drop(subset=keys).drop("Average_Value", "Instrument_Status", "Status")
    other = build_graph(df, described=described)
    for table in ("station", "item"):
        assert sorted(getattr(other, table).collect(), key=str) == sorted(
            getattr(graph, table).collect(), key=str
        )


def test_address_is_optional(spark):
    df = spark.createDataFrame(ROWS, ENRICHED).drop("Address")
    assert build_graph(df).station.first()["Address"] is None


def test_key_audit(spark, graph):
    raw = spark.createDataFrame([(1,), (1,), (2,), (None,)], "code int")
    lines = key_audit([("X", raw, ["code"]), ("M", graph.measurement, MEASUREMENT_ID)]).collect()
    assert [tuple(r) for r in lines] == [
        ("X", "code", 3, 2, 1),
        ("M", ",".join(MEASUREMENT_ID), 6, 6, 0),
    ]


def test_measurement_merge_reuses_the_cleaned_partitioning(spark):
    from sensorloom.operators.clean import clean_measure

    raw = spark.createDataFrame(ROWS, ENRICHED).select(
        "Measurement_Date", "Station_Code", "Item_Code", "Average_Value", "Instrument_Status", "Status"
    )
    named = clean_measure(raw).selectExpr(
        "*", "'s' Station_Name", "1D Latitude", "1D Longitude", "'i' Item_Name", "'u' Unit"
    )
    plan = build_graph(named).measurement._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
