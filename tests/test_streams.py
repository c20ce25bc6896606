import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sensorloom.functions.messages import decode_messages, to_messages
from sensorloom.operators.clean import clean_measure
from sensorloom.operators.enrich import enrich_measure
from sensorloom.operators.reports import (
    bad_records,
    bad_records_hourly,
    item_status_pretty,
    item_status_stats,
)
from sensorloom.plans.tables import Tables
from sensorloom.schemas import ENRICHED, MEASUREMENT_KEY
from sensorloom.sources import kafka
from sensorloom.sources.files import header_schema, read_csv, shared_folder, write_csv
from sensorloom.streaming import streams

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


@pytest.fixture(scope="module")
def csv_path(tables, tmp_path_factory):
    """The enriched measurements as ten CSV files."""
    path = str(tmp_path_factory.mktemp("csv") / "processed")
    write_csv(tables.enriched, path, files=10)
    return path


@pytest.fixture(scope="module")
def schema(spark, csv_path):
    return streams.borrowed_schema(spark, csv_path)


def same(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.select(left.columns).collect()))


def test_csv_round_trip(spark, tables, csv_path):
    back = read_csv(spark, csv_path, ENRICHED)
    assert back.schema == ENRICHED
    expected = tables.enriched.select([F.col(f.name).cast(f.dataType) for f in ENRICHED.fields])
    assert same(back, expected)


def test_csv_default_file_count(spark, tmp_path):
    write_csv(spark.range(100), str(tmp_path / "out"))
    assert read_csv(spark, str(tmp_path / "out")).count() == 100
    from pyspark.sql.types import StructType

    assert read_csv(spark, str(tmp_path / "out"), StructType([])).dtypes == [("id", "int")]


def test_csv_without_header(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("1,a\n2,b\n")
    assert read_csv(spark, str(tmp_path / "plain.csv"), header=False).columns == ["_c0", "_c1"]


def test_header_schema(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_bytes("﻿Measurement date, Station code ,\"a,b\"\n1,2,3\n".encode())
    schema = header_schema(spark, str(path))
    assert schema.fieldNames() == ["Measurement date", "Station code", "a,b"]
    assert {f.dataType.simpleString() for f in schema.fields} == {"string"}
    for text in ("", "\n"):
        empty = tmp_path / "empty.csv"
        empty.write_text(text)
        with pytest.raises(ValueError):
            header_schema(spark, str(empty))


def test_one_file_per_batch(spark, csv_path, schema, tmp_path):
    source = streams.file_stream(spark, csv_path, schema)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "chk")
    query = streams.append_stream(bad_records(source), out, checkpoint, drain=True)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 10


def test_stream_item_status(spark, csv_path, schema):
    source = streams.file_stream(spark, csv_path, schema)
    query = streams.table_stream(item_status_stats(source), "item_status_stats", "complete", drain=True)
    query.awaitTermination()
    live = spark.table("item_status_stats")
    batch = item_status_stats(read_csv(spark, csv_path, schema))
    assert same(live.drop("avg_value"), batch.drop("avg_value"))
    assert same(item_status_pretty(live), item_status_pretty(batch))


def test_only_complete_results_are_kept_in_memory(spark, csv_path, schema):
    source = streams.file_stream(spark, csv_path, schema)
    with pytest.raises(ValueError):
        streams.table_stream(bad_records(source), "rows", "append")


def test_stream_bad_records(spark, csv_path, schema, tmp_path):
    static = read_csv(spark, csv_path, schema)
    for name, report in (("bad", bad_records), ("bad_hourly", bad_records_hourly)):
        source = streams.file_stream(spark, csv_path, schema)
        out = str(tmp_path / name)
        streams.append_stream(
            report(source), out, str(tmp_path / f"{name}-chk"), drain=True
        ).awaitTermination()
        assert same(spark.read.parquet(out), report(static))
    ordered = streams.bad_records_by_time(spark.read.parquet(str(tmp_path / "bad")))
    times = [r["Measurement_Date"] for r in ordered.collect()]
    assert len(times) > 1 and times == sorted(times)


def test_snapshot_stream(spark, csv_path, schema, tmp_path):
    totals = item_status_stats(streams.file_stream(spark, csv_path, schema, files_per_trigger=3))
    out = str(tmp_path / "out")
    streams.snapshot_stream(totals, out, str(tmp_path / "chk"), drain=True).awaitTermination()
    batch = item_status_stats(read_csv(spark, csv_path, schema))
    assert same(streams.read_snapshot(spark, out).drop("avg_value"), batch.drop("avg_value"))


def test_snapshot_is_whole_while_it_is_replaced(spark, tmp_path):
    out = str(tmp_path / "out")
    assert streams.read_snapshot(spark, out) is None
    spark.range(3).write.parquet(f"{out}/batch=0")
    reader = streams.read_snapshot(spark, out)
    spark.range(5).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{out}/batch=1")
    assert reader.count() == streams.read_snapshot(spark, out).count() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{out}/batch=1")
    assert reader.count() == 3 and streams.read_snapshot(spark, out).count() == 5


@pytest.mark.parametrize("sink_format", ["parquet", "CSV"])
def test_append_survives_a_restart(spark, tmp_path, sink_format):
    incoming, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "chk"))
    text = spark.range(100).select(
        F.col("id").cast("string").alias("a b"), F.lit("x").alias("a_b")
    )

    def run():
        source = streams.file_stream(
            spark, incoming, to_messages(text).schema, source_format="json", files_per_trigger=None
        )
        rows = decode_messages(source, text.schema)
        streams.append_stream(
            rows, out, checkpoint, sink_format, sanitize_names=True, drain=True
        ).awaitTermination()

    listener = streams.BatchRows()
    spark.streams.addListener(listener)
    to_messages(text.filter("`a b` < 60")).write.json(incoming)
    run()
    run()
    to_messages(text.filter("`a b` >= 60")).write.mode("append").json(incoming)
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(listener)
    reader = spark.read.option("header", True)
    stored = reader.format(sink_format.lower()).load(out)
    assert stored.columns == ["a_b", "a_b_2"]
    assert sorted(int(r["a_b"]) for r in stored.collect()) == list(range(100))
    assert listener.total == 100


def test_unknown_sink_format(spark, csv_path, schema, tmp_path):
    source = streams.file_stream(spark, csv_path, schema)
    with pytest.raises(ValueError):
        streams.append_stream(source, str(tmp_path / "o"), str(tmp_path / "c"), "orc")


def test_a_failing_batch_fails_the_query_and_keeps_its_rows(spark, csv_path, schema, tmp_path):
    source = streams.file_stream(spark, csv_path, schema, files_per_trigger=None)
    broken = source.select(F.when(F.col("Item_Code") > 0, F.raise_error(F.lit("boom"))).cast("string").alias("x"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "chk")
    with pytest.raises(StreamingQueryException):
        streams.append_stream(broken, out, checkpoint, drain=True).awaitTermination()
    mended = source.select(F.col("Item_Code").cast("string").alias("x"))
    streams.append_stream(mended, out, checkpoint, drain=True).awaitTermination()
    assert spark.read.parquet(out).count() == read_csv(spark, csv_path, schema).count()


@pytest.mark.parametrize("watermark", [None, "5000 days"])
def test_clean_stream_equals_batch(spark, tables, tmp_path, watermark):
    incoming = str(tmp_path / "in")
    tables.measurement_raw.repartitionByRange(4, "Measurement_Date").write.parquet(incoming)
    source = streams.file_stream(
        spark, incoming, tables.measurement_raw.schema, source_format="parquet"
    )
    cleaned = streams.clean_measure_stream(source, watermark)
    out = str(tmp_path / "out")
    streams.append_stream(cleaned, out, str(tmp_path / "chk"), drain=True).awaitTermination()
    keys = list(MEASUREMENT_KEY)
    assert same(spark.read.parquet(out).select(keys), clean_measure(tables.measurement_raw).select(keys))


def test_clean_sink_keeps_whole_rows_and_survives_a_restart(spark, tables, tmp_path):
    incoming, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "chk"))
    raw = tables.measurement_raw
    raw.repartitionByRange(4, "Measurement_Date").write.parquet(incoming)

    def run():
        source = streams.file_stream(spark, incoming, raw.schema, source_format="parquet")
        streams.clean_measure_sink(source, out, checkpoint, drain=True).awaitTermination()
        return spark.read.parquet(out).drop("batch", "day")

    # Copies of a reading lie in one file, so the lowest one survives as in the batch operator.
    expected = clean_measure(raw)
    assert same(run().select(expected.columns), expected)
    late = raw.withColumn("Average_Value", F.col("Average_Value") - F.lit(0.25))
    new = raw.limit(5).withColumn("Measurement_Date", F.lit("2031-01-01").cast("timestamp"))
    late.unionByName(new).coalesce(1).write.mode("append").parquet(incoming)
    again = run()
    known = again.filter("Measurement_Date < '2031-01-01'").select(expected.columns)
    assert known.join(expected, list(MEASUREMENT_KEY), "left_anti").count() + expected.count() == known.count()
    assert known.intersectAll(expected).count() == expected.count()
    assert again.count() == again.select(*MEASUREMENT_KEY).distinct().count()


def test_stream_with_many_missing_keys(spark, tables, tmp_path):
    incoming = str(tmp_path / "in")
    rows = tables.measurement.withColumn(
        "Station_Code", F.when(F.col("Item_Code") > 3, F.col("Station_Code"))
    )
    rows.write.parquet(incoming)
    source = streams.file_stream(spark, incoming, rows.schema, source_format="parquet")
    out = str(tmp_path / "out")
    enriched = enrich_measure(source, tables.station, tables.item, max_rows=0)
    streams.append_stream(enriched, out, str(tmp_path / "chk"), drain=True).awaitTermination()
    assert same(spark.read.parquet(out), enrich_measure(rows, tables.station, tables.item))


def test_stream_joins_large_lookups(spark, tables, csv_path, tmp_path):
    incoming = str(tmp_path / "in")
    tables.measurement.write.parquet(incoming)
    source = streams.file_stream(
        spark, incoming, tables.measurement.schema, source_format="parquet"
    )
    enriched = enrich_measure(source, tables.station, tables.item, max_rows=0)
    out = str(tmp_path / "out")
    streams.append_stream(enriched, out, str(tmp_path / "chk"), drain=True).awaitTermination()
    assert same(spark.read.parquet(out), tables.enriched)


def test_list_and_stop_queries(spark, csv_path, schema):
    source = streams.file_stream(spark, csv_path, schema)
    streams.table_stream(item_status_stats(source), "running", "complete")
    assert [name for name, _, status in streams.active_queries(spark) if "message" in status] == ["running"]
    streams.stop_all(spark)
    assert streams.active_queries(spark) == []


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_the_warehouse_stands_in_for_the_shared_folder():
    class Conf:
        def get(self, key, *default):
            return default[0] if default else "store://warehouse/"

    class Session:
        conf = Conf()

    assert shared_folder(Session(), "x").startswith("store://warehouse/x-")


def test_kafka_options():
    assert kafka.source_options("host:9092", "topic") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "topic",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def test_messages_are_json_objects(spark, tables):
    value = to_messages(tables.measurement).first()["value"]
    assert set(json.loads(value)) == set(tables.measurement.columns)
