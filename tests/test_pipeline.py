"""The jobs one after the other, each on what the last one stored."""

import pytest
from pyspark.sql import functions as F

from sensorloom.functions.messages import decode_messages, to_messages
from sensorloom.operators.documents import historical_trend, latest_snapshot
from sensorloom.operators.graph import (
    MEASUREMENT_ID,
    build_graph,
    daily_avg,
    edge_rows,
    hot_spots,
    merge_graphs,
)
from sensorloom.operators.reports import bad_records, item_status_stats
from sensorloom.plans import pipeline
from sensorloom.plans.tables import Tables, item_source, measurement_text, station_source
from sensorloom.schemas import ENRICHED, GRADES, RULES, WIDE_CODES
from sensorloom.sources.documents import read_collection
from sensorloom.sources.graphs import read_edges, read_graph
from sensorloom.streaming.streams import read_snapshot

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    """Landed messages, dimension files, and the processed result with its audit."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    t = Tables(spark, FOLDER)
    text = measurement_text(t.read("lineitem"))
    decode_messages(to_messages(text), text.schema).write.parquet(f"{folder}/landed")
    for name, df in (
        ("station", station_source(t.read("supplier"))),
        ("item", item_source(t.read("part"))),
    ):
        df.coalesce(1).write.option("header", True).csv(f"{folder}/{name}")
    audit = pipeline.process(
        spark, f"{folder}/landed", f"{folder}/station", f"{folder}/item", f"{folder}/out", 10
    )
    return folder, audit


def test_process(spark, work, tmp_path_factory):
    folder, audit = work
    stored = pipeline.read_processed(spark, f"{folder}/out")
    lines = {(r["Table"], r["Outcome"]): r["Rows"] for r in audit.row_counts.collect()}
    assert stored.count() == lines["measurement", "Clean"]
    raw = lines["measurement", "Raw"]
    assert raw == sum(
        n for (table, outcome), n in lines.items() if table == "measurement" and outcome != "Raw"
    )
    assert audit.errors.count() == sum(r["count"] for r in audit.error_counts.collect())
    summary = {r["Rule_ID"]: r["Validations"] for r in audit.summary.collect()}
    assert tuple(summary) == RULES
    for clean_rule in ("Duplicates", "Nulls", "Negative_Values", "Bad_Status"):
        assert summary[clean_rule] == audit.details[clean_rule].count() == 0


@pytest.mark.parametrize("store_format", ["parquet", "csv"])
@pytest.mark.parametrize("change", ["missing", "extra", "reordered"])
def test_stored_layout_is_fixed(spark, work, tmp_path, change, store_format):
    folder, _ = work
    for name, last in (("station", "Address"), ("item", "Unit of measurement")):
        rows = spark.read.option("header", True).csv(f"{folder}/{name}")
        if change == "missing":
            rows = rows.drop(last) if name == "station" else rows
        elif change == "extra":
            rows = rows.select(rows.columns[0], F.lit("City").alias("Owner" + name), *rows.columns[1:])
        else:
            rows = rows.select(*reversed(rows.columns))
        rows.coalesce(1).write.option("header", True).csv(f"{tmp_path}/{name}")
    store = pipeline.Store(store_format)
    audit = pipeline.process(
        spark, f"{folder}/landed", f"{tmp_path}/station", f"{tmp_path}/item", f"{tmp_path}/out", store=store
    )
    stored = pipeline.read_processed(spark, f"{tmp_path}/out", store)
    expected = pipeline.read_processed(spark, f"{folder}/out")
    if change == "missing":
        expected = expected.withColumn("Address", F.lit(None).cast("string"))
    assert stored.schema == ENRICHED
    assert stored.exceptAll(expected).count() == expected.exceptAll(stored).count() == 0
    assert {r["Status"] for r in stored.select("Status").distinct().collect()} <= set(GRADES)
    assert audit.summary.count() == len(RULES)


def test_csv_of_another_layout_is_refused(spark, work, tmp_path):
    folder, _ = work
    rows = pipeline.read_processed(spark, f"{folder}/out").drop("Address")
    rows.write.option("header", True).csv(f"{tmp_path}/out")
    with pytest.raises(Exception, match="(?i)header"):
        pipeline.read_processed(spark, f"{tmp_path}/out", pipeline.Store("csv")).collect()


def test_wide_codes_survive(spark, work, tmp_path):
    folder, _ = work
    code = 3_000_000_000
    landed = spark.read.parquet(f"{folder}/landed").limit(1)
    one = landed.select(
        F.lit("2020-01-01 00:00").alias("Measurement date"),
        F.lit("1").alias("Station code"),
        F.lit(str(code)).alias("Item code"),
        F.lit("1.5").alias("Average value"),
        F.lit("0").alias("Instrument status"),
    )
    one.write.parquet(f"{tmp_path}/landed")
    store = pipeline.Store(types=WIDE_CODES)
    args = (f"{tmp_path}/landed", f"{folder}/station", f"{folder}/item", f"{tmp_path}/out")
    pipeline.process(spark, *args, bad_statuses=(x for x in (2, 4)), store=store)
    stored = pipeline.read_processed(spark, f"{tmp_path}/out", store)
    assert [r["Item_Code"] for r in stored.collect()] == [code]
    pipeline.load_documents(spark, f"{tmp_path}/out", *args[1:3], f"{tmp_path}/docs", store=store)
    loaded = read_collection(spark, f"{tmp_path}/docs/measurements")
    assert loaded.first()["meta"]["item_code"] == code
    assert pipeline.load_graph(spark, f"{tmp_path}/out", f"{tmp_path}/g", store=store).item.count() == 1


def test_documents(spark, work, tmp_path):
    folder, _ = work
    args = (spark, f"{folder}/out", f"{folder}/station", f"{folder}/item", str(tmp_path))
    rows = pipeline.read_processed(spark, f"{folder}/out").count()
    first = pipeline.load_documents(*args)
    assert first["measurements"].inserted == rows
    pipeline.load_documents(*args)
    items, stations, measurements = (
        read_collection(spark, f"{tmp_path}/{n}") for n in ("items", "stations", "measurements")
    )
    assert measurements.count() == 2 * rows
    assert items.count() == first["items"].inserted
    snapshot = latest_snapshot(measurements, items, stations)
    assert snapshot.count() == snapshot.select("Station Code", "Item Code").distinct().count()
    assert historical_trend(measurements, items, stations, 1, 5).count() > 0


def test_graph(spark, work, tmp_path):
    folder, _ = work
    stored = pipeline.load_graph(spark, f"{folder}/out", f"{tmp_path}/g1")
    built = build_graph(pipeline.read_processed(spark, f"{folder}/out"))
    assert hot_spots(stored).collect() == hot_spots(built).collect()
    assert daily_avg(stored).collect() == daily_avg(built).collect()
    assert read_edges(spark, f"{tmp_path}/g1", "AT_TIME").count() == stored.measurement.count()
    again = pipeline.load_graph(spark, f"{folder}/out", f"{tmp_path}/g2", f"{tmp_path}/g1")
    assert edge_rows(again).exceptAll(edge_rows(stored)).count() == 0
    assert read_graph(spark, f"{tmp_path}/g2").station.count() == stored.station.count()


def test_merge_keeps_vertices_and_updates_measurements(spark, work):
    folder, _ = work
    old_rows = pipeline.read_processed(spark, f"{folder}/out")
    one = old_rows.orderBy("Measurement_Date", "Station_Code", "Item_Code").limit(1).collect()
    changed = spark.createDataFrame(one, ENRICHED).withColumns(
        {"Station_Name": F.lit("new"), "Average_Value": F.lit(0.5), "Status": F.lit("New")}
    )
    old, new = build_graph(old_rows), build_graph(changed)
    merged = merge_graphs(old, new)
    assert merged.measurement.count() == old.measurement.count()
    updated = merged.measurement.join(new.measurement.select(MEASUREMENT_ID), MEASUREMENT_ID)
    assert [(r["Value"], r["Status"]) for r in updated.collect()] == [(0.5, "New")]
    assert merged.station.filter("Name = 'new'").count() == 0
    assert merged.status.filter("Level = 'New'").count() == 1


def test_watch(spark, work, tmp_path):
    folder, _ = work
    for query in pipeline.watch(spark, f"{folder}/out", str(tmp_path), drain=True):
        query.awaitTermination()
    rows = pipeline.read_processed(spark, f"{folder}/out")
    bad = spark.read.parquet(f"{tmp_path}/bad_records")
    assert bad.exceptAll(bad_records(rows)).count() == 0
    assert bad.count() == bad_records(rows).count()
    totals = read_snapshot(spark, f"{tmp_path}/item_status").select("Item_Name", "Status", "Count")
    expected = item_status_stats(rows).select("Item_Name", "Status", "Count")
    assert sorted(totals.collect(), key=str) == sorted(expected.collect(), key=str)


def test_ingest_decodes_and_appends(spark, work, tmp_path, monkeypatch):
    folder, _ = work
    landed = spark.read.parquet(f"{folder}/landed")
    to_messages(landed).write.text(f"{tmp_path}/messages")
    header = tmp_path / "h.csv"
    header.write_text(",".join(landed.columns) + "\n")
    monkeypatch.setattr(
        pipeline,
        "kafka_stream",
        lambda spark, servers, topic: spark.readStream.text(f"{tmp_path}/messages"),
    )
    query = pipeline.ingest(
        spark, "", "", str(header), f"{tmp_path}/out", f"{tmp_path}/chk", sanitize_names=True
    )
    query.processAllAvailable()
    query.stop()
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert stored.columns == [c.replace(" ", "_") for c in landed.columns]
    assert stored.toDF(*landed.columns).exceptAll(landed).count() == 0
    assert stored.count() == landed.count()


def test_ingest_needs_the_connector(spark, work, tmp_path):
    folder, _ = work
    header = tmp_path / "h.csv"
    header.write_text("a,b\n")
    with pytest.raises(Exception, match="(?i)kafka"):
        pipeline.ingest(spark, "host:1", "t", str(header), f"{tmp_path}/o", f"{tmp_path}/c")
