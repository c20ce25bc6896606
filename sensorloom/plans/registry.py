"""Every query by name, as a function of the session and a folder of tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.functions.columns import recast, sanitize_columns, trim_strings
from sensorloom.functions.messages import decode_messages, to_messages
from sensorloom.operators import documents, graph, quality, reports
from sensorloom.operators.clean import valid_measurements
from sensorloom.plans.pipeline import Store, read_processed, write_processed
from sensorloom.plans.tables import Tables, measurement_source, measurement_text
from sensorloom.operators.enrich import enrich_measure
from sensorloom.schemas import MEASUREMENT, WIDE_CODES
from sensorloom.sources.documents import (
    insert_documents,
    insert_history,
    insert_measurements,
    load_collection,
    load_measurements,
    read_collection,
    read_history,
)
from sensorloom.sources.files import read_csv, read_csv_lines, shared_folder, write_csv
from sensorloom.sources.graphs import upsert_graph
from sensorloom.streaming import snapshots, streams

Query = Callable[[SparkSession, str], DataFrame]

# The point that the history queries look up.
HISTORY_ITEM, HISTORY_STATION = 1, 5

# The first of two overlapping loads ends, and the second starts.
EARLY_END, LATE_START = "1995-07-01", "1995-01-01"

# Bounds a micro-batch when a stream works through a large backlog.
FILES_PER_TRIGGER = 100

VALIDATION_KEYS = {
    "validate_duplicates": "Duplicates",
    "validate_nulls": "Nulls",
    "validate_missing_station": "Missing_Station_Info",
    "validate_missing_item": "Missing_Item_Info",
    "validate_orphan_station": "Orphan_Station",
    "validate_orphan_item": "Orphan_Item",
    "validate_negative": "Negative_Values",
    "validate_bad_status": "Bad_Status",
    "validate_bad_latlong": "Bad_Latitude_Longitude",
}


def recast_text(t: Tables) -> DataFrame:
    return recast(measurement_text(t.read("lineitem")), MEASUREMENT, WIDE_CODES)


def trimmed_names(t: Tables) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.col("c_name"), F.lit("  "))
    return trim_strings(t.read("customer").select("c_custkey", padded.alias("c_name")))


def sanitized_names(t: Tables) -> DataFrame:
    stations = t.station_source.withColumn("Station_code", F.col("`Station code`") + 1)
    return sanitize_columns(stations)


def messages(t: Tables) -> DataFrame:
    return to_messages(measurement_text(t.read("lineitem")))


def decoded_messages(t: Tables) -> DataFrame:
    text = measurement_text(t.read("lineitem"))
    return decode_messages(to_messages(text), text.schema)


def flat_items(t: Tables) -> DataFrame:
    return documents.item_documents(t.item_source, "bigint").select(
        "_id", "name", "unit", "thresholds.*"
    )


def flat_stations(t: Tables) -> DataFrame:
    return flat_station_documents(documents.station_documents(t.station_source, "bigint"))


def flat_station_documents(stations: DataFrame) -> DataFrame:
    return stations.select(
        "_id",
        "name",
        "address",
        "location.type",
        F.col("location.coordinates")[0].alias("longitude"),
        F.col("location.coordinates")[1].alias("latitude"),
    )


def flat_measurements(t: Tables) -> DataFrame:
    return documents.measurement_documents(t.enriched, "bigint").select(
        "ts", "avg", "instrument_status", "status", "meta.*"
    )


def enriched_by_shuffle(t: Tables) -> DataFrame:
    """The enrichment as it runs with lookup tables too large to broadcast."""
    return enrich_measure(
        t.measurement,
        t.station,
        t.item,
        hot_from=t.measurement_raw,
        hot_rows=1000,
        max_rows=50,
    )


def stored_measurements(t: Tables) -> DataFrame:
    """The measurement documents after a load into a collection partitioned by month."""
    folder = shared_folder(t.spark, "measurements")
    load_measurements(
        documents.measurement_documents(t.enriched, "bigint"), folder, period="month"
    )
    stored = read_collection(t.spark, folder)
    return stored.select("ts", "avg", "instrument_status", "status", "meta.*")


def csv_roundtrip(t: Tables) -> DataFrame:
    """The enriched measurements written as CSV and read back with their schema."""
    folder = shared_folder(t.spark, "csv")
    write_csv(t.enriched, folder)
    return read_csv(t.spark, folder, t.enriched.schema)


def malformed_lines(t: Tables) -> DataFrame:
    """All lines of a CSV of measurements in which items 5 lack the last field and items 6 have one
    more, with what became of them."""
    text = measurement_text(t.read("lineitem"))
    fields = [F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in text.columns]
    item = F.coalesce(F.col("`Item code`"), F.lit(""))
    line = F.when(item == "5", F.concat_ws(",", *fields[:-1])).otherwise(
        F.concat(F.concat_ws(",", *fields), F.when(item == "6", ",more").otherwise(""))
    )
    folder = shared_folder(t.spark, "lines")
    text.select(line).write.text(folder)
    rows, malformed = read_csv_lines(t.spark, folder, text.schema, header=False)
    return rows.select(F.lit("row").alias("Kind"), F.concat_ws(",", *fields).alias("Line")).union(
        malformed.select(F.lit("malformed"), "Line")
    )


def processed_roundtrip(t: Tables) -> DataFrame:
    """Measurements enriched from a station table with a column more, in another order, stored
    between the jobs as CSV and read back."""
    station = t.station.select("Address", F.lit("x").alias("Owner"), *t.station.columns[:-1])
    enriched = enrich_measure(t.measurement, station, t.item, hot_from=t.measurement_raw)
    folder, store = shared_folder(t.spark, "processed"), Store("csv", WIDE_CODES)
    write_processed(enriched, folder, store=store)
    return read_processed(t.spark, folder, store)


def load_twice(t: Tables) -> DataFrame:
    """Attempted and inserted documents of loads that overlap: the bad measurements and then all
    of them twice, and the most urgent orders by customer and then all of them."""
    folder = shared_folder(t.spark, "loads")
    rows = documents.measurement_documents(t.enriched, "bigint")
    bad = rows.filter("status = 'Bad'")
    incoming, _ = offered_documents(t)
    urgent = incoming.filter("name LIKE '1%'")
    loads = [
        ("measurements 1", load_measurements(bad, f"{folder}/m", period="month", distinct=True)),
        (
            "measurements 2",
            load_measurements(rows.union(rows), f"{folder}/m", period="month", distinct=True),
        ),
        ("orders 1", load_collection(urgent, f"{folder}/o", order=["order_no"])),
        (
            "orders 2",
            load_collection(incoming, f"{folder}/o", drop_existing=False, order=["order_no"]),
        ),
    ]
    return t.spark.createDataFrame(
        [(name, counts.attempted, counts.inserted) for name, counts in loads],
        "Load string, Attempted bigint, Inserted bigint",
    )


def store_loads(t: Tables) -> DataFrame:
    """The loads of ``load_twice`` into a store that knows its keys by period and by bucket."""
    folder = shared_folder(t.spark, "store")
    rows = documents.measurement_documents(t.enriched, "bigint")
    incoming, _ = offered_documents(t)
    measured = [rows.filter("status = 'Bad'"), rows.union(rows)]
    ordered = [incoming.filter("name LIKE '1%'"), incoming]
    loads = [insert_measurements(r, folder, period="yyyy-MM") for r in measured]
    loads += [insert_documents(o, folder, "orders", order=["order_no"], buckets=8) for o in ordered]
    names = ["measurements 1", "measurements 2", "orders 1", "orders 2"]
    return t.spark.createDataFrame(
        [(name, counts.attempted, counts.inserted) for name, counts in zip(names, loads)],
        "Load string, Attempted bigint, Inserted bigint",
    )


def edge_documents(t: Tables) -> DataFrame:
    """Station documents from a source with every code twice, missing codes and missing
    coordinates; the one of the least name is kept."""
    nation = F.substring_index("Address", " ", -1).cast("int")
    source = t.station_source.withColumns(
        {
            "Station code": F.when(nation != 3, F.col("`Station code`")),
            "Latitude": F.when(nation != 5, F.col("Latitude")),
        }
    )
    name = F.col("`Station name(district)`")
    again = source.withColumn("Station name(district)", F.concat(F.lit("B"), name))
    offered = documents.station_documents(source.unionByName(again), "bigint")
    return flat_station_documents(documents.insert_ignore(offered, order=["name"]))


def conflicting_graph(t: Tables) -> graph.Graph:
    """A graph from uncleaned rows in which the name of a station changes from year to year."""
    year = F.year("Measurement_Date").cast("string")
    name = F.concat(F.coalesce("Station_Name", F.lit("?")), year)
    return graph.build_graph(t.enriched_raw.withColumn("Station_Name", name))


def graph_conflicts(t: Tables) -> DataFrame:
    """The vertices that several writes compete for."""
    built = conflicting_graph(t)
    rows = built.measurement.select(
        F.lit("Measurement").alias("Label"),
        *graph.MEASUREMENT_ID,
        "Value",
        "Instrument_Status",
        "Status",
    )
    named = built.station.select(F.lit("Station").alias("Label"), "Station_Code", "Name")
    return rows.unionByName(named, allowMissingColumns=True)


def upserted_graph(t: Tables) -> DataFrame:
    """The vertices of a stored graph after two loads that overlap by half a year. The later one
    brings other values and other names of stations."""
    folder = shared_folder(t.spark, "graph")
    time = F.col("Measurement_Date")
    upsert_graph(t.enriched.filter(time < F.lit(EARLY_END).cast("timestamp")), folder)
    late = t.enriched.filter(time >= F.lit(LATE_START).cast("timestamp")).withColumns(
        {
            "Average_Value": F.col("Average_Value") + 1,
            "Station_Name": F.concat("Station_Name", F.lit("!")),
        }
    )
    return graph.vertex_rows(upsert_graph(late, folder))


def stored_clean(t: Tables) -> DataFrame:
    """Clean measurements from a store that takes the early readings, then all, then all again
    under the same number."""
    folder = shared_folder(t.spark, "clean")
    valid = valid_measurements(t.measurement_raw)
    early = valid.filter(F.col("Measurement_Date") < F.lit(EARLY_END).cast("timestamp"))
    for batch_id, batch in ((0, early), (1, valid), (1, valid)):
        streams.store_clean_batch(batch, folder, batch_id, period="yyyy-MM")
    return streams.read_clean(t.spark, folder)


def kept_results(t: Tables) -> str:
    """The folder of results kept up to date by two micro-batches, the second taken twice."""
    folder = shared_folder(t.spark, "results")
    first = F.col("Measurement_Date") < F.lit(EARLY_END).cast("timestamp")
    late = t.enriched.filter(~first)
    for batch_id, batch in ((0, t.enriched.filter(first)), (1, late), (1, late)):
        snapshots.take_batch(batch, folder, batch_id)
    return folder


def offered_documents(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders as documents keyed by customer, and supplier keys as the documents present."""
    incoming = t.read("orders").select(
        F.col("o_custkey").alias("_id"),
        F.col("o_orderkey").alias("order_no"),
        F.col("o_orderpriority").alias("name"),
    )
    return incoming, t.read("supplier").select(F.col("s_suppkey").alias("_id"))


def collections(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        documents.measurement_documents(t.enriched, "bigint"),
        documents.item_documents(t.item_source, "bigint"),
        documents.station_documents(t.station_source, "bigint"),
    )


def snapshot(t: Tables) -> DataFrame:
    return documents.latest_snapshot(*collections(t))


def history(t: Tables) -> DataFrame:
    return documents.historical_trend(*collections(t), HISTORY_ITEM, HISTORY_STATION)


def stored_history(t: Tables) -> DataFrame:
    """The history from a collection laid out for it, after two loads that overlap."""
    rows, items, stations = collections(t)
    folder = shared_folder(t.spark, "history")
    insert_history(rows.filter(F.col("ts") < F.lit(EARLY_END).cast("timestamp")), folder)
    insert_history(rows, folder)
    kept = read_history(t.spark, folder, HISTORY_ITEM, HISTORY_STATION)
    return documents.historical_trend(kept, items, stations, HISTORY_ITEM, HISTORY_STATION)


def key_audit(t: Tables) -> DataFrame:
    vertices = graph.build_graph(t.enriched, writes_folder=shared_folder(t.spark, "writes"))
    raw_key = ["Station_Code", "Item_Code", "Measurement_Date"]
    return graph.key_audit(
        [
            ("Station", t.station_raw, ["Station_Code"]),
            ("Item", t.item_raw, ["Item_Code"]),
            ("Measurement input", t.measurement_raw, raw_key),
            ("Status", vertices.status, ["Level"]),
            ("MeasurementTime", vertices.time, ["Raw_Datetime"]),
            ("Measurement", vertices.measurement, graph.MEASUREMENT_ID),
            ("Measurement", vertices.measurement, ["Station_Code", "Item_Code", "Datetime"]),
        ]
    )


def lineitem_stream(t: Tables) -> DataFrame:
    # The bracket makes the path a pattern: it finds a single file as well as a folder of files.
    return streams.file_stream(
        t.spark,
        f"{t.folder}/[l]ineitem.parquet",
        t.read("lineitem").schema,
        source_format="parquet",
        files_per_trigger=FILES_PER_TRIGGER,
    )


def drained(
    t: Tables, start: Callable, rows: DataFrame, purpose: str, snapshot: bool = False
) -> DataFrame:
    """Run a stream over all present input and read what it wrote."""
    folder = shared_folder(t.spark, purpose)
    start(rows, f"{folder}/out", f"{folder}/checkpoint", drain=True).awaitTermination()
    if snapshot:
        return streams.read_snapshot(t.spark, f"{folder}/out")
    return t.spark.read.parquet(f"{folder}/out")


def streamed_enriched(t: Tables) -> DataFrame:
    """Uncleaned measurements of the stream joined to the cleaned lookups."""
    raw = recast(measurement_source(lineitem_stream(t)), MEASUREMENT, WIDE_CODES)
    return enrich_measure(raw, t.station, t.item)


def stream_append(t: Tables) -> DataFrame:
    schema = measurement_text(t.read("lineitem")).schema
    sent = to_messages(measurement_text(lineitem_stream(t)))
    return drained(t, streams.append_stream, decode_messages(sent, schema), "append")


def stream_clean(t: Tables) -> DataFrame:
    raw = recast(measurement_source(lineitem_stream(t)), MEASUREMENT, WIDE_CODES)
    return drained(t, streams.clean_measure_sink, raw, "clean").drop("batch", "day")


def stream_item_status(t: Tables) -> DataFrame:
    totals = reports.item_status_stats(streamed_enriched(t))
    return drained(t, streams.snapshot_stream, totals, "item-status", snapshot=True)


def stream_bad_records(t: Tables) -> DataFrame:
    bad = reports.bad_records(streamed_enriched(t))
    return drained(t, streams.append_stream, bad, "bad-records")


PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    "recast": recast_text,
    "trim_strings": trimmed_names,
    "sanitize_columns": sanitized_names,
    "json_encode": messages,
    "json_decode": decoded_messages,
    "clean_station": lambda t: t.station,
    "clean_item": lambda t: t.item,
    "clean_measure": lambda t: t.measurement,
    "clean_report": lambda t: quality.clean_report(
        t.measurement_raw, t.station_raw, t.item_raw
    ),
    "zero_values": lambda t: reports.zero_values(t.measurement),
    "detect_errors": lambda t: quality.detect_errors(t.measurement_raw),
    "error_counts": lambda t: quality.error_counts(quality.detect_errors(t.measurement_raw)),
    "enrich_measure": lambda t: t.enriched,
    "enrich_measure_shuffled": enriched_by_shuffle,
    "csv_roundtrip": csv_roundtrip,
    "csv_malformed": malformed_lines,
    "validate_summary": lambda t: quality.validation_summary(
        t.enriched_raw, t.station_raw, t.item_raw
    ),
    **{
        key: lambda t, rule=rule: quality.validation_details(
            t.enriched_raw, t.station_raw, t.item_raw
        )[rule]
        for key, rule in VALIDATION_KEYS.items()
    },
    "doc_items": flat_items,
    "doc_stations": flat_stations,
    "doc_measurements": flat_measurements,
    "doc_stored_measurements": stored_measurements,
    "doc_insert_ignore": lambda t: documents.insert_ignore(
        *offered_documents(t), order=["order_no"]
    ),
    "doc_insert_counts": lambda t: documents.insert_counts(*offered_documents(t)),
    "latest_snapshot": snapshot,
    "latest_snapshot_report": lambda t: documents.latest_snapshot_report(snapshot(t)),
    "historical_trend": history,
    "history_store": stored_history,
    "history_head": lambda t: documents.history_head(history(t)),
    "graph_vertices": lambda t: graph.vertex_rows(t.written_graph),
    "graph_edges": lambda t: graph.edge_rows(t.lazy_graph),
    "graph_key_audit": key_audit,
    "graph_paths": lambda t: graph.match_paths(t.graph, hot_from=t.measurement_raw),
    "hot_spots": lambda t: graph.hot_spots(t.graph),
    "hot_spots_top": lambda t: graph.hot_spots(t.graph).limit(30),
    "daily_avg": lambda t: graph.daily_avg(t.graph),
    "item_status_stats": lambda t: reports.item_status_stats(t.enriched),
    "item_status_pretty": lambda t: reports.item_status_pretty(
        reports.item_status_stats(t.enriched)
    ),
    "processed_roundtrip": processed_roundtrip,
    "doc_load_twice": load_twice,
    "doc_store_loads": store_loads,
    "doc_edge_cases": edge_documents,
    "graph_upsert": upserted_graph,
    "graph_conflicts": graph_conflicts,
    "graph_rejected": lambda t: conflicting_graph(t).rejected,
    "stream_bad_records_by_time": lambda t: streams.bad_records_by_time(stream_bad_records(t)),
    "bad_records": lambda t: reports.bad_records(t.enriched),
    "bad_records_hourly": lambda t: reports.bad_records_hourly(t.enriched),
    "stream_append": stream_append,
    "stream_clean": stream_clean,
    "stream_clean_store": stored_clean,
    "stream_item_status": stream_item_status,
    "latest_store": lambda t: snapshots.read_latest(t.spark, kept_results(t)),
    "item_status_store": lambda t: snapshots.read_totals(t.spark, kept_results(t)),
    "stream_bad_records": stream_bad_records,
}


def queries() -> dict[str, Query]:
    def bind(plan: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, folder: plan(Tables(spark, folder))

    return {name: bind(plan) for name, plan in PLANS.items()}
