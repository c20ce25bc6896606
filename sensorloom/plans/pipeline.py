"""The five jobs from raw files to answers, built from the operators.

Each writes its result as files and hands back lazy tables, so that the next job reads what the
last one stored.
"""

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sensorloom.functions.columns import recast
from sensorloom.functions.messages import decode_messages
from sensorloom.operators.clean import clean_item, clean_measure, clean_station
from sensorloom.operators.documents import (
    item_documents,
    measurement_documents,
    station_documents,
)
from sensorloom.operators.enrich import enrich_measure
from sensorloom.operators.graph import Graph, build_graph, merge_graphs
from sensorloom.operators.quality import (
    clean_report,
    detect_errors,
    error_counts,
    validation_details,
    validation_summary,
)
from sensorloom.operators.reports import bad_records, item_status_stats
from sensorloom.schemas import (
    BAD_INSTRUMENT_STATUS,
    ITEM,
    MEASUREMENT,
    STATION,
    enriched_schema,
)
from sensorloom.sources.documents import LoadCounts, load_collection, load_measurements
from sensorloom.sources.files import header_schema, read_csv, read_csv_lines, write_csv
from sensorloom.sources.graphs import read_graph, save_graph
from sensorloom.sources.kafka import kafka_stream
from sensorloom.streaming.streams import append_stream, file_stream, snapshot_stream


@dataclass(frozen=True)
class Store:
    """How results are kept between the jobs: "parquet" or "csv", with single types overridden,
    such as by ``WIDE_CODES`` where codes outgrow an int."""

    format: str = "parquet"
    types: Mapping[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return enriched_schema(self.types)


def ingest(
    spark: SparkSession,
    servers: str,
    topic: str,
    header_csv: str,
    path: str,
    checkpoint: str,
    sink_format: str = "parquet",
    sanitize_names: bool = False,
    **source_options,
) -> StreamingQuery:
    """Append the messages of a topic to files of text columns named by a CSV header."""
    schema = header_schema(spark, header_csv)
    messages = kafka_stream(spark, servers, topic, **source_options)
    rows = decode_messages(messages, schema, plain_nan=True)
    return append_stream(rows, path, checkpoint, sink_format, sanitize_names)


@dataclass(frozen=True)
class Audit:
    """Reports of a batch run; the tables are lazy."""

    row_counts: DataFrame
    errors: DataFrame
    error_counts: DataFrame
    summary: DataFrame
    details: dict[str, DataFrame]
    malformed: dict[str, DataFrame] = field(default_factory=dict)


def process(
    spark: SparkSession,
    measurement_path: str,
    station_csv: str,
    item_csv: str,
    out_path: str,
    files: int | None = None,
    bad_statuses: Iterable[int] | None = BAD_INSTRUMENT_STATUS,
    store: Store = Store(),
) -> Audit:
    """Clean, enrich and store the ingested measurements, and audit the outcome.

    The validation reads the stored result, so that nothing is cleaned or joined twice for it.
    """
    bad_statuses = None if bad_statuses is None else tuple(bad_statuses)
    raw = recast(spark.read.parquet(measurement_path), MEASUREMENT, store.types)
    stations, bad_stations = read_csv_lines(spark, station_csv)
    items, bad_items = read_csv_lines(spark, item_csv)
    malformed = {"station": bad_stations, "item": bad_items}
    station_raw, item_raw = recast(stations, STATION, store.types), recast(items, ITEM, store.types)
    measure = clean_measure(raw, bad_statuses=bad_statuses)
    station, item = clean_station(station_raw), clean_item(item_raw)
    write_processed(enrich_measure(measure, station, item, hot_from=raw), out_path, files, store)

    stored = read_processed(spark, out_path, store)
    errors = detect_errors(raw, bad_statuses=bad_statuses)
    flagged = tuple(bad_statuses or BAD_INSTRUMENT_STATUS)
    return Audit(
        row_counts=clean_report(
            raw, station_raw, item_raw, bad_statuses=bad_statuses, malformed=malformed
        ),
        errors=errors,
        error_counts=error_counts(errors),
        summary=validation_summary(stored, station, item, flagged),
        details=validation_details(stored, station, item, flagged),
        malformed=malformed,
    )


def write_processed(
    enriched: DataFrame, path: str, files: int | None = None, store: Store = Store()
) -> None:
    """Store exactly the declared columns, in their order: a missing one as a typed NULL, others
    left out, so that what reads the result never meets another layout."""
    present = set(enriched.columns)
    rows = enriched.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in store.schema.fields
        ]
    )
    if store.format == "csv":
        write_csv(rows, path, files)
        return
    spread = rows.hint("rebalance") if files is None else rows.repartition(files)
    spread.write.mode("overwrite").parquet(path)


def read_processed(spark: SparkSession, path: str, store: Store = Store()) -> DataFrame:
    """The stored result of ``process`` with its declared types. A CSV file whose header is not
    the declared one is refused."""
    if store.format == "csv":
        reader = spark.read.option("header", True).option("enforceSchema", False)
        return reader.schema(store.schema).csv(path)
    return spark.read.schema(store.schema).parquet(path)


def load_documents(
    spark: SparkSession,
    processed_path: str,
    station_csv: str,
    item_csv: str,
    folder: str,
    drop_measurements: bool = False,
    store: Store = Store(),
    distinct: bool = False,
) -> dict[str, LoadCounts]:
    """Store items and stations anew and add the measurements, as document collections. With
    ``distinct`` a measurement is added once, however often it is loaded."""
    return {
        "items": load_collection(item_documents(read_csv(spark, item_csv)), f"{folder}/items"),
        "stations": load_collection(
            station_documents(read_csv(spark, station_csv)), f"{folder}/stations"
        ),
        "measurements": load_measurements(
            measurement_documents(
                read_processed(spark, processed_path, store), store.types.get("Item_Code", "int")
            ),
            f"{folder}/measurements",
            drop_measurements,
            distinct=distinct,
        ),
    }


def load_graph(
    spark: SparkSession,
    processed_path: str,
    folder: str,
    previous: str | None = None,
    store: Store = Store(),
) -> Graph:
    """Store the measurements as a graph, merged into the one stored at ``previous`` if given."""
    graph = build_graph(read_processed(spark, processed_path, store))
    if previous is not None:
        graph = merge_graphs(read_graph(spark, previous), graph)
    return save_graph(graph, folder)


def watch(
    spark: SparkSession,
    processed_path: str,
    folder: str,
    drain: bool = False,
    store: Store = Store(),
) -> tuple[StreamingQuery, StreamingQuery]:
    """Keep the status totals and the bad readings up to date as result files arrive."""
    rows = file_stream(spark, processed_path, store.schema, store.format)
    totals = snapshot_stream(
        item_status_stats(rows),
        f"{folder}/item_status",
        f"{folder}/checkpoints/item_status",
        drain,
    )
    bad = append_stream(
        bad_records(rows),
        f"{folder}/bad_records",
        f"{folder}/checkpoints/bad_records",
        drain=drain,
    )
    return totals, bad
