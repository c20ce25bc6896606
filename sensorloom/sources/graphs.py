"""A property graph kept as one parquet table per vertex and edge kind."""

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.operators.graph import MEASUREMENT_ID, Graph, build_graph, edge_tables
from sensorloom.sources.store import PieceStore


def save_graph(graph: Graph, folder: str) -> Graph:
    """Write the vertex tables, the edge tables and the rejected rows; return the stored graph.

    Edges are written from the stored measurements, so the input is not computed again for them.
    An upsert reads its old tables while it runs and needs a new folder.
    """
    spark = graph.measurement.sparkSession
    for field in fields(Graph):
        getattr(graph, field.name).write.parquet(f"{folder}/{field.name}")
    stored = read_graph(spark, folder)
    for kind, table in edge_tables(stored).items():
        table.write.parquet(f"{folder}/{kind}")
    return stored


def read_graph(spark: SparkSession, folder: str) -> Graph:
    """The vertex tables under ``folder``."""
    return Graph(**{f.name: spark.read.parquet(f"{folder}/{f.name}") for f in fields(Graph)})


def read_edges(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """One edge table under ``folder``."""
    return spark.read.parquet(f"{folder}/{kind}")


# Into how many partitions stations and items are dealt by their codes.
CODE_BUCKETS = 32


def upsert_graph(
    enriched: DataFrame, folder: str, seq: str | None = None, period: str = "yyyy-MM"
) -> Graph:
    """Merge enriched measurements into the graph kept in ``folder``; return the graph after it.

    The outcome is that of ``merge_graphs``, at the cost of the change. The input is read once: its
    rows are staged and all vertices derive from them. Measurements lie by ``period``, a pattern of
    dates that gives a period's worth of rows; only the periods that come in are read and rewritten.
    New stations, items and statuses are added beside the stored ones. All tables change at once, or
    none does. Times follow from the measurements and are not stored.
    """
    store = PieceStore(enriched.sparkSession, folder)
    change = store.begin()
    incoming = build_graph(change.stage(enriched), seq)
    by_period = F.date_format("Raw_Datetime", period)
    change.upsert("measurement", incoming.measurement.withColumn("Period", by_period), MEASUREMENT_ID, "Period")
    for name, key in (("station", "Station_Code"), ("item", "Item_Code")):
        bucket = F.pmod(F.col(key), F.lit(CODE_BUCKETS)).cast("int")
        change.insert_new(name, getattr(incoming, name).withColumn("Bucket", bucket), [key], "Bucket")
    one = F.lit(0).alias("Part")
    change.insert_new("status", incoming.status.select("*", one), ["Level", "Part"], "Part")
    change.append("rejected", incoming.rejected.select("*", one), "Part")
    change.commit()
    return stored_graph(enriched.sparkSession, folder)


def stored_graph(spark: SparkSession, folder: str, version: int | None = None) -> Graph | None:
    """The graph that ``upsert_graph`` keeps in a folder, the newest or that of a version; None
    before the first."""
    store = PieceStore(spark, folder)
    manifest = store.manifest(version)
    if not manifest.tables:
        return None

    def table(name: str) -> DataFrame:
        return store.pieces(name, manifest.tables[name]).drop(manifest.tables[name].partition)

    measurement = table("measurement")
    return Graph(
        **{name: table(name) for name in ("station", "item", "status", "rejected")},
        time=measurement.select("Raw_Datetime", "Datetime").distinct(),
        measurement=measurement,
    )
