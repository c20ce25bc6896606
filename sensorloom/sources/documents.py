"""Document collections kept as parquet tables."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from sensorloom.operators.dedup import first_per_key
from sensorloom.operators.documents import insert_ignore
from sensorloom.sources.files import shared_folder
from sensorloom.sources.store import PieceStore


@dataclass(frozen=True)
class LoadCounts:
    """Documents offered to a collection and documents it took."""

    attempted: int
    inserted: int


def read_collection(spark: SparkSession, path: str) -> DataFrame | None:
    """The collection at ``path``, or None if there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_collection(
    documents: DataFrame,
    path: str,
    drop_existing: bool = True,
    key: str | None = "_id",
    order: Sequence[str] = (),
) -> LoadCounts:
    """Write documents, replacing the collection or adding to it.

    With a ``key``, documents whose key is already there are ignored, and of several incoming
    ones of a key the first by ``order`` is taken. Rows of a table have no order of their own:
    without one the document of the least content is taken. Both counts are observed while the
    write runs, so nothing is computed twice.
    """
    offered, taken = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    incoming = documents.observe(offered, rows)
    if key is not None:
        existing = None if drop_existing else read_collection(documents.sparkSession, path)
        incoming = insert_ignore(incoming, existing, key, order)
    incoming.observe(taken, rows).write.mode(
        "overwrite" if drop_existing else "append"
    ).parquet(path)
    return LoadCounts(offered.get["rows"], taken.get["rows"])


def load_measurements(
    documents: DataFrame,
    path: str,
    drop_existing: bool = False,
    period: str = "day",
    distinct: bool = False,
) -> LoadCounts:
    """Write measurement documents by period of time; a repeated load repeats its rows.

    With ``distinct`` one document per time, station and item is kept, the least of the incoming
    ones, and those already stored are left out. Only the stored periods between the first and
    the last incoming one are read for that. The incoming ones are computed once: they are counted
    while they are reduced.

    Choose the ``period`` ("day", "month" or "year") so that one holds at least a file's worth of
    rows. The rebalance gathers the rows of a period into few files and splits a period that is
    too large for one. Within a file rows are sorted by station, item and time, which lets the
    point query skip row groups.
    """
    offered, before, folder = Observation(), 0, None
    incoming = documents.observe(offered, F.count(F.lit(1)).alias("rows"))
    if distinct:
        incoming = _keyed_first(incoming)
        stored = None if drop_existing else read_collection(documents.sparkSession, path)
        if stored is not None:
            # Written once, as the times that it spans are asked for before it is compared.
            folder = shared_folder(documents.sparkSession, "incoming")
            incoming.write.parquet(folder)
            incoming = documents.sparkSession.read.schema(incoming.schema).parquet(folder)
            before = stored.count()
            incoming = _unstored(incoming, stored, period)
        incoming = incoming.drop("_station", "_item")
    dated = (
        incoming.withColumn(period, F.to_date(F.date_trunc(period, "ts")))
        .hint("rebalance", period)
        .sortWithinPartitions(period, "meta.station_code", "meta.item_code", "ts")
    )
    mode = "overwrite" if drop_existing else "append"
    dated.write.mode(mode).partitionBy(period).parquet(path)
    if not distinct:
        return LoadCounts(offered.get["rows"], offered.get["rows"])
    taken = read_collection(documents.sparkSession, path).count() - before
    # A plan that turns out empty while it runs observes nothing.
    known = taken if folder is None else documents.sparkSession.read.parquet(folder).count()
    if folder is not None:
        PieceStore(documents.sparkSession, folder).delete()
    return LoadCounts(offered.get["rows"] if known else 0, taken)


_KEYS = ["ts", "_station", "_item"]


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({"_station": F.col("meta.station_code"), "_item": F.col("meta.item_code")})


def _keyed_first(incoming: DataFrame) -> DataFrame:
    """The first document per time, station and item, with its keys."""
    return first_per_key(_keyed(incoming), _KEYS)


def _unstored(incoming: DataFrame, stored: DataFrame, period: str) -> DataFrame:
    """The keyed documents that are not stored."""
    first, last = incoming.agg(F.min("ts"), F.max("ts")).first()
    start = F.to_date(F.date_trunc(period, F.lit(first)))
    near = stored.filter(F.col(period).between(start, F.to_date(F.lit(last))))
    return incoming.join(_keyed(near).select(_KEYS), _KEYS, "left_anti").select(incoming.columns)


# Into how many partitions documents are dealt by their keys.
KEY_BUCKETS = 64


def _offered(documents: DataFrame) -> tuple[DataFrame, Callable[[int], int]]:
    """The documents, and how many they were once they are inserted, given how many were taken.
    They are counted while the load reduces them; a plan that turns out empty while it runs
    observes nothing, so where none was taken they are counted apart."""
    offered = Observation()
    counted = documents.observe(offered, F.count(F.lit(1)).alias("rows"))
    return counted, lambda taken: offered.get["rows"] if taken else documents.count()


def insert_documents(
    documents: DataFrame,
    folder: str,
    name: str,
    key: str = "_id",
    order: Sequence[str] = (),
    buckets: int = KEY_BUCKETS,
) -> LoadCounts:
    """Add the documents whose key the collection ``name`` of a store lacks.

    Documents lie in buckets of their keys. A load reads the keys of the buckets that it brings
    documents for, and the store knows its rows, so nothing stored is counted. Choose ``buckets``
    so that one holds a file's worth of documents, and keep it: it is part of the layout.
    """
    change = PieceStore(documents.sparkSession, folder).begin()
    counted, attempted = _offered(documents)
    bucket = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")
    inserted = change.insert_new(name, counted.withColumn("Bucket", bucket), [key], "Bucket", order)
    change.commit()
    return LoadCounts(attempted(inserted), inserted)


def insert_measurements(
    documents: DataFrame, folder: str, name: str = "measurements", period: str = "yyyy-MM-dd"
) -> LoadCounts:
    """Add measurement documents, one per time, station and item, unless it is there.

    Documents lie by ``period``, a pattern of dates; a load reads the keys of its own periods.
    Within a file they are sorted by time, station and item.
    """
    change = PieceStore(documents.sparkSession, folder).begin()
    counted, attempted = _offered(documents)
    keyed = counted.withColumns(
        {
            "_station": F.col("meta.station_code"),
            "_item": F.col("meta.item_code"),
            "Period": F.date_format("ts", period),
        }
    )
    inserted = change.insert_new(name, keyed, ["ts", "_station", "_item"], "Period")
    change.commit()
    return LoadCounts(attempted(inserted), inserted)


def _cell(item_code: Column | int, station_code: Column | int, cells: int) -> Column | int:
    mixed = station_code * 1_000_003 + item_code
    return mixed % cells if isinstance(mixed, int) else F.pmod(mixed, F.lit(cells)).cast("int")


def insert_history(
    documents: DataFrame, folder: str, name: str = "history", cells: int = KEY_BUCKETS
) -> LoadCounts:
    """Add measurement documents to a collection that is laid out for the history of one item at one
    station: by cells of both codes, and inside a file by station, item and time. Documents that are
    there, or without a code, are left out. Keep ``cells``: it is part of the layout."""
    change = PieceStore(documents.sparkSession, folder).begin()
    counted, attempted = _offered(documents)
    station, item = F.col("meta.station_code").cast("bigint"), F.col("meta.item_code").cast("bigint")
    keyed = counted.filter(station.isNotNull() & item.isNotNull()).withColumns(
        {"_station": station, "_item": item, "Cell": _cell(item, station, cells)}
    )
    inserted = change.insert_new(name, keyed, ["_station", "_item", "ts"], "Cell")
    change.commit()
    return LoadCounts(attempted(inserted), inserted)


def read_history(
    spark: SparkSession,
    folder: str,
    item_code: int,
    station_code: int,
    name: str = "history",
    cells: int = KEY_BUCKETS,
) -> DataFrame | None:
    """The documents of one item at one station. Only the files of their cell are listed and opened,
    and in those only the row groups whose range holds the codes are read."""
    store = PieceStore(spark, folder)
    rows = store.read(name, [str(_cell(item_code, station_code, cells))])
    if rows is None:
        return None
    matched = rows.filter((F.col("_station") == station_code) & (F.col("_item") == item_code))
    return matched.drop("_station", "_item", "Cell")


def stored_documents(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """The documents of a store's collection, without the columns of its layout; None if there is
    none."""
    found = PieceStore(spark, folder).read(name)
    return None if found is None else found.drop("Bucket", "Period", "Cell", "_station", "_item")
