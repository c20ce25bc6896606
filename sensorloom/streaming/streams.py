"""Stream sources, sinks and queries."""

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from sensorloom.functions.columns import sanitize_columns
from sensorloom.operators.clean import valid_measurements
from sensorloom.operators.dedup import first_per_key
from sensorloom.schemas import BAD_INSTRUMENT_STATUS, MEASUREMENT_KEY, TIME_FORMAT
from sensorloom.sources.files import read_csv
from sensorloom.sources.store import MOST_PIECES, PieceStore

log = logging.getLogger(__name__)

BATCH_ROWS = "batch_rows"
SINK_FORMATS = ("parquet", "csv")


def borrowed_schema(spark: SparkSession, path: str) -> StructType:
    """The schema of a static read of the same CSV files."""
    return read_csv(spark, path).schema


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    source_format: str = "csv",
    files_per_trigger: int | None = 1,
) -> DataFrame:
    """Files arriving under ``path``, a bounded number of them per micro-batch."""
    reader = spark.readStream.format(source_format).schema(schema)
    if source_format == "csv":
        reader = reader.option("header", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    sink_format: str = "parquet",
    sanitize_names: bool = False,
    drain: bool = False,
) -> StreamingQuery:
    """Append a stream to files, exactly once per row across restarts.

    A failing write fails the query and leaves its offsets uncommitted. ``drain`` stops once
    the present input is used up. ``BatchRows`` reports the rows of each micro-batch.
    """
    sink_format = sink_format.lower()
    if sink_format not in SINK_FORMATS:
        raise ValueError(f"sink_format must be one of {', '.join(SINK_FORMATS)}")
    out = sanitize_columns(rows) if sanitize_names else rows
    writer = (
        out.observe(BATCH_ROWS, F.count(F.lit(1)).alias("rows"))
        .writeStream.format(sink_format)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if sink_format == "csv":
        writer = writer.option("header", True)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def table_stream(
    rows: DataFrame, name: str, output_mode: str, drain: bool = False
) -> StreamingQuery:
    """Keep an aggregated stream's result as a named in-memory table, for inspection.

    The table lies on the driver, so only complete results of a bounded number of groups are
    taken: use ``append_stream`` for rows and ``snapshot_stream`` for large totals.
    """
    if output_mode != "complete":
        raise ValueError("only complete results are kept in memory; rows go to append_stream")
    writer = rows.writeStream.format("memory").queryName(name).outputMode(output_mode)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def snapshot_stream(
    totals: DataFrame, path: str, checkpoint: str, drain: bool = False
) -> StreamingQuery:
    """Keep the running totals of an aggregated stream under ``path``, a folder per micro-batch.

    ``read_snapshot`` gives the newest complete one. A folder is never changed while it may be
    read: the one before the newest stays, older ones go.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        files, root = _files(batch.sparkSession, path)
        for old in _complete_batches(files, root):
            if old < batch_id - 1:
                files.delete(_child(batch.sparkSession, root, f"batch={old}"), True)

    writer = (
        totals.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
    )
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _files(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _child(spark: SparkSession, root, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(root, name)


def _complete_batches(files, root) -> list[int]:
    """The ids of the micro-batches under a folder whose writing has ended."""
    if not files.exists(root):
        return []
    names = [status.getPath() for status in files.listStatus(root)]
    return sorted(
        int(name.getName().removeprefix("batch="))
        for name in names
        if name.getName().startswith("batch=") and files.exists(name.suffix("/_SUCCESS"))
    )


def read_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete totals that ``snapshot_stream`` has written, None before the first."""
    batches = _complete_batches(*_files(spark, path))
    return spark.read.parquet(f"{path}/batch={batches[-1]}") if batches else None


def bad_records_by_time(stored: DataFrame) -> DataFrame:
    """The bad readings that a stream has stored, in order of time."""
    return stored.orderBy("Measurement_Date", "Station_Name", "Item_Code", "Value")


def clean_measure_sink(
    measurements: DataFrame,
    path: str,
    checkpoint: str,
    time_format: str | None = TIME_FORMAT,
    bad_statuses: Iterable[int] | None = BAD_INSTRUMENT_STATUS,
    drain: bool = False,
) -> StreamingQuery:
    """Store the valid readings of a stream, one per time, station and item.

    The first micro-batch that brings a key decides; within it the lowest reading does, as in
    ``clean_measure``. Each micro-batch is reduced to one row per key, which combines before the
    shuffle, and joined against the stored keys of the days it touches, so no state is kept and
    nothing is too late. A micro-batch has its own folder and replaces what a broken attempt left.
    """
    valid = valid_measurements(measurements, time_format=time_format, bad_statuses=bad_statuses)
    keys = list(MEASUREMENT_KEY)

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = first_per_key(batch, keys).withColumn("day", F.to_date("Measurement_Date"))
        files, root = _files(spark, path)
        before = [b for b in _complete_batches(files, root) if b < batch_id]
        if before:
            first, last = batch.agg(
                F.to_date(F.min("Measurement_Date")), F.to_date(F.max("Measurement_Date"))
            ).first()
            folders = [f"{path}/batch={b}" for b in before]
            schema = fresh.schema
            known = spark.read.schema(schema).option("basePath", path).parquet(*folders)
            known = known.filter(F.col("day").between(F.lit(first), F.lit(last)))
            fresh = fresh.join(known.select(keys), keys, "left_anti")
        fresh.write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={batch_id}")

    writer = valid.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def store_clean_batch(
    valid: DataFrame,
    folder: str,
    batch_id: int,
    most_pieces: int = MOST_PIECES,
    period: str = "yyyy-MM-dd",
) -> int | None:
    """Add a micro-batch of valid readings to the store in ``folder``; how many were new, None if
    the micro-batch is in it already.

    The rows of a key that come first are kept, the lowest of one micro-batch. The batch is computed
    once and reduced to a row per key; only the stored keys of the periods in it are read, whatever
    lies between those and however many micro-batches went before. A period has at most
    ``most_pieces`` folders, which are then made one. Choose ``period``, a pattern of dates, so that
    one holds at least a file's worth of rows, and keep it.
    """
    change = PieceStore(valid.sparkSession, folder).begin(batch_id)
    if change is None:
        return None
    dated = valid.withColumn("Period", F.date_format("Measurement_Date", period))
    added = change.insert_new("clean", dated, list(MEASUREMENT_KEY), "Period", most_pieces=most_pieces)
    change.commit()
    return added


def clean_measure_store(
    measurements: DataFrame,
    folder: str,
    checkpoint: str,
    time_format: str | None = TIME_FORMAT,
    bad_statuses: Iterable[int] | None = BAD_INSTRUMENT_STATUS,
    drain: bool = False,
    most_pieces: int = MOST_PIECES,
    period: str = "yyyy-MM-dd",
) -> StreamingQuery:
    """Keep the valid readings of a stream, one per time, station and item, in a store.

    The rows are those of ``clean_measure_sink``, for streams that run for long: see
    ``store_clean_batch``. One stream writes to a store; a micro-batch that is run again after a
    failure changes nothing. ``read_clean`` gives the rows.
    """
    valid = valid_measurements(measurements, time_format=time_format, bad_statuses=bad_statuses)
    writer = valid.writeStream.foreachBatch(
        lambda batch, batch_id: store_clean_batch(batch, folder, batch_id, most_pieces, period)
    ).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_clean(spark: SparkSession, folder: str) -> DataFrame | None:
    """The readings that ``clean_measure_store`` has kept, None before the first."""
    found = PieceStore(spark, folder).read("clean")
    return None if found is None else found.drop("Period")


def clean_measure_stream(
    measurements: DataFrame,
    watermark: str | None,
    time_format: str | None = TIME_FORMAT,
    bad_statuses: Iterable[int] | None = BAD_INSTRUMENT_STATUS,
) -> DataFrame:
    """Valid readings of a stream, the first to arrive per time, station and item.

    ``watermark`` says how late a reading may come; the state of older keys is then dropped, and
    later arrivals with it. None keeps every key and every reading. Copies that arrive in one
    micro-batch meet in one task, so let the source bound its batches.
    """
    valid = valid_measurements(
        measurements, time_format=time_format, bad_statuses=bad_statuses
    )
    if watermark is not None:
        valid = valid.withWatermark("Measurement_Date", watermark)
    return valid.dropDuplicates(list(MEASUREMENT_KEY))


class BatchRows(StreamingQueryListener):
    """Logs and totals the rows of each micro-batch as observed by the running query itself."""

    def __init__(self) -> None:
        self.total = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        observed = event.progress.observedMetrics.get(BATCH_ROWS)
        if observed is not None:
            self.total += observed["rows"]
            log.info("batch %d: %d rows", event.progress.batchId, observed["rows"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def active_queries(spark: SparkSession) -> list[tuple[str | None, str, dict]]:
    """Name, id and status of the running queries."""
    return [(q.name, q.id, q.status) for q in spark.streams.active]


def stop_all(spark: SparkSession) -> None:
    """Stop every running query of the session."""
    for query in spark.streams.active:
        query.stop()
