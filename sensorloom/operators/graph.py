"""A property graph as vertex and edge tables, and the queries over it.

Every edge touches exactly one measurement, and a measurement's key and status name its other
end. The edge tables therefore follow from the measurement vertices without another shuffle,
and a two-hop match is a pair of joins by code.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.operators.dedup import first_per_key
from sensorloom.operators.joins import join_lookups, join_small

# In the key order of cleaned measurements, whose sorting and partitioning then carry over.
MEASUREMENT_ID = ["Raw_Datetime", "Station_Code", "Item_Code"]

# Edge types with the labels they connect.
EDGES = (
    ("HAS_MEASUREMENT", "Station", "Measurement"),
    ("MEASURED_IN", "Measurement", "Item"),
    ("AT_TIME", "Measurement", "MeasurementTime"),
    ("HAS_STATUS", "Measurement", "Status"),
)


@dataclass(frozen=True)
class Graph:
    """Vertex tables, and the input rows that no vertex can be made of."""

    station: DataFrame
    item: DataFrame
    status: DataFrame
    time: DataFrame
    measurement: DataFrame
    rejected: DataFrame


STATION_PROPERTIES = {
    "Name": "Station_Name",
    "Latitude": "Latitude",
    "Longitude": "Longitude",
    "Address": "Address",
}
ITEM_PROPERTIES = {"Name": "Item_Name", "Unit": "Unit"}


def _with_address(rows: DataFrame) -> DataFrame:
    if "Address" in rows.columns:
        return rows
    return rows.withColumn("Address", F.lit(None).cast("string"))


def _versions(rows: DataFrame, written: Column) -> DataFrame:
    """Every combination of station and item properties with its first write.

    A fixed-width minimum makes this a hash aggregate that shrinks inside each input partition,
    however the keys are skewed. Station and item vertices both come from it, so the
    measurements are read once for the two, and only for their keys.
    """
    described = [
        "Station_Code",
        *STATION_PROPERTIES.values(),
        "Item_Code",
        *ITEM_PROPERTIES.values(),
    ]
    return rows.groupBy(*described).agg(F.min(written).alias("_written"))


def _first_written(versions: DataFrame, key: str, properties: Mapping[str, str]) -> DataFrame:
    """One vertex per key with the properties of its first write."""
    named = [F.col(source).alias(name) for name, source in properties.items()]
    return first_per_key(
        versions.select(key, *named, "_written"), [key], order=["_written"]
    ).drop("_written")


def build_graph(
    enriched: DataFrame,
    seq: str | None = None,
    folder: str | None = None,
    described: DataFrame | None = None,
    writes_folder: str | None = None,
) -> Graph:
    """Merge enriched measurements into vertices.

    Stations and items keep their first write, measurements their last. ``seq`` names the
    column that gives the write order; by default rows are written in time order. Writes of
    equal order are ranked by their content. Rows with a NULL in any key are set apart.

    Everything is lazy unless ``folder`` names a place for the properties of stations and items.
    They are then written there, one line per combination, and queries over these vertices need
    not derive them from the measurements again; a folder that exists is refused.

    ``described`` is a cheaper source of those properties: a table with the station and item
    columns of ``enriched`` and the first write order of each station and item in it, such as
    one aggregated from the scan before any deduplication.

    ``writes_folder`` names a place for the last write of every measurement and status. The
    measurements, statuses and times then all derive from that one pass over the input.
    """
    enriched = _with_address(enriched)
    keys = ["Station_Code", "Item_Code", "Status", "Measurement_Date"]
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    rows = enriched.filter(complete)
    written = F.col(seq or "Measurement_Date")

    order = ["_written"] if seq else []
    writes = rows.select(
        F.col("Measurement_Date").alias("Raw_Datetime"),
        "Station_Code",
        "Item_Code",
        *([written.alias("_written")] if seq else []),
        F.col("Average_Value").alias("Value"),
        "Instrument_Status",
        "Status",
    )
    if writes_folder is not None:
        first_per_key(writes, [*MEASUREMENT_ID, "Status"], order, last=True).write.parquet(writes_folder)
        writes = enriched.sparkSession.read.schema(writes.schema).parquet(writes_folder)
    measurement = first_per_key(writes, MEASUREMENT_ID, order, last=True).drop("_written")
    versions = _versions(rows if described is None else _with_address(described), written)
    if folder is not None:
        versions.write.parquet(folder)
        versions = enriched.sparkSession.read.schema(versions.schema).parquet(folder)
    return Graph(
        station=_first_written(versions, "Station_Code", STATION_PROPERTIES),
        item=_first_written(versions, "Item_Code", ITEM_PROPERTIES),
        status=writes.select(F.col("Status").alias("Level")).distinct(),
        time=writes.select("Raw_Datetime")
        .distinct()
        .withColumn("Datetime", F.col("Raw_Datetime").cast("timestamp")),
        measurement=measurement.withColumn("Datetime", F.col("Raw_Datetime").cast("timestamp")),
        rejected=enriched.filter(~complete),
    )


def merge_graphs(stored: Graph, incoming: Graph) -> Graph:
    """The graph after an upsert of ``incoming`` into ``stored``.

    Stations, items and times keep their stored properties, measurements take the incoming ones.
    """

    def merged(name: str, keys: Sequence[str], incoming_wins: bool = False) -> DataFrame:
        old = getattr(stored, name).withColumn("_load", F.lit(0))
        new = getattr(incoming, name).withColumn("_load", F.lit(1))
        both = old.unionByName(new)
        return first_per_key(both, keys, order=["_load"], last=incoming_wins).drop("_load")

    return Graph(
        station=merged("station", ["Station_Code"]),
        item=merged("item", ["Item_Code"]),
        status=stored.status.union(incoming.status).distinct(),
        time=merged("time", ["Raw_Datetime"]),
        measurement=merged("measurement", MEASUREMENT_ID, incoming_wins=True),
        rejected=stored.rejected.unionByName(incoming.rejected),
    )


def vertex_rows(graph: Graph) -> DataFrame:
    """All vertices in one table; columns that a label lacks are NULL."""
    labelled = {
        "Measurement": graph.measurement,
        "Station": graph.station,
        "Item": graph.item,
        "Status": graph.status,
        "MeasurementTime": graph.time,
    }
    out = None
    for label, table in labelled.items():
        rows = table.withColumn("Label", F.lit(label))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def edge_rows(graph: Graph) -> DataFrame:
    """All edges in one table: the edge type, its measurement, and the status it leads to.

    The measurement's key holds the station, item and time ends. One pass over the measurement
    vertices emits the four edges of each.
    """
    kinds = F.array(
        *[
            F.struct(F.lit(t).alias("Type"), F.lit(a).alias("From"), F.lit(b).alias("To"))
            for t, a, b in EDGES
        ]
    )
    return graph.measurement.select(
        F.inline(kinds), *MEASUREMENT_ID, F.col("Status").alias("_status")
    ).select(
        "Type",
        "From",
        "To",
        *MEASUREMENT_ID,
        F.when(F.col("Type") == "HAS_STATUS", F.col("_status")).alias("Level"),
    )


def edge_tables(graph: Graph) -> dict[str, DataFrame]:
    """One table per edge type: the measurement's key and the key at the other end."""
    other_end = {
        "HAS_MEASUREMENT": F.col("Station_Code"),
        "MEASURED_IN": F.col("Item_Code"),
        "AT_TIME": F.col("Raw_Datetime"),
        "HAS_STATUS": F.col("Status"),
    }
    return {
        kind: graph.measurement.select(*MEASUREMENT_ID, end.alias("Other"))
        for kind, end in other_end.items()
    }


def _names(graph: Graph) -> dict[str, DataFrame]:
    """The ``Station`` and ``Pollutant`` names that belong to the codes."""
    return {
        "Station_Code": graph.station.select("Station_Code", F.col("Name").alias("Station")),
        "Item_Code": graph.item.select("Item_Code", F.col("Name").alias("Pollutant")),
    }


def match_paths(graph: Graph, hot_from: DataFrame | None = None) -> DataFrame:
    """Every path from a station over a measurement to an item, with both names. ``hot_from`` is a
    cheaper table to find the hot codes in, should the names be too many to broadcast."""
    return join_lookups(graph.measurement, _names(graph), hot_from)


def hot_spots(graph: Graph) -> DataFrame:
    """Share of bad readings per station and item, worst first.

    Aggregates by code before looking names up, so two vertices of one name stay apart and the
    lookups see one row per pair.
    """
    is_bad = F.col("Status").contains("Bad")
    pairs = graph.measurement.groupBy("Station_Code", "Item_Code").agg(
        F.count(F.lit(1)).alias("Total"),
        F.sum(F.when(is_bad, 1).otherwise(0)).alias("Bad_Count"),
        F.round(F.avg("Value"), 2).alias("Avg_Value"),
        F.max("Value").alias("Worst_Value"),
    )
    share = F.round(F.lit(100.0) * F.col("Bad_Count") / F.col("Total"), 2)
    return (
        join_small(pairs, _names(graph))
        .withColumn("Weightage", share)
        .orderBy(
            F.desc_nulls_first("Weightage"),
            F.desc_nulls_first("Avg_Value"),
            F.desc_nulls_first("Worst_Value"),
            "Station_Code",
            "Item_Code",
        )
        .select(
            "Station",
            "Pollutant",
            "Bad_Count",
            "Total",
            "Weightage",
            "Avg_Value",
            "Worst_Value",
        )
    )


def daily_avg(graph: Graph) -> DataFrame:
    """Mean value per day, station name and item name, by day and station.

    Vertices that share a name, or have none, fall into one group. Values are summed by code and
    day before names are looked up, so the lookups see one row per pair and day.
    """
    sums = graph.measurement.groupBy(
        F.to_date("Datetime").alias("Day"), "Station_Code", "Item_Code"
    ).agg(F.sum("Value").alias("_sum"), F.count("Value").alias("_count"))
    mean = F.try_divide(F.sum("_sum"), F.sum("_count"))
    return (
        join_small(sums, _names(graph))
        .groupBy("Day", "Station", "Pollutant")
        .agg(F.round(mean, 2).alias("Daily_Avg_Value"))
        .orderBy("Day", "Station", "Pollutant")
    )


def key_audit(tables: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """For each (label, table, key): rows, distinct keys and keys held by several rows.

    A uniqueness constraint holds where ``Violations`` is zero. Rows with a NULL in the key are
    outside a constraint and are not counted. The keys of one table are counted in one scan of it,
    as grouping sets; give the same DataFrame for them.
    """
    entries: dict[int, list[tuple[int, str, list[str]]]] = {}
    by_id = {id(table): table for _, table, _ in tables}
    for order, (label, table, key) in enumerate(tables):
        entries.setdefault(id(table), []).append((order, label, list(key)))
    out = None
    for identity, lines in entries.items():
        audited = _audited(by_id[identity], lines)
        out = audited if out is None else out.union(audited)
    return out.orderBy("_order").drop("_order")


def _audited(table: DataFrame, lines: Sequence[tuple[int, str, list[str]]]) -> DataFrame:
    """A line for each (order, label, key) of one table."""
    columns = list(dict.fromkeys(name for *_, key in lines for name in key))
    sets = list(dict.fromkeys(tuple(sorted(set(key))) for *_, key in lines))
    groups = table.select(*columns).groupingSets([list(s) for s in sets], *columns).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n")
    )
    counts, structs = [], []
    for order, label, key in lines:
        number = sum(1 << i for i, name in enumerate(reversed(columns)) if name not in key)
        held = F.col("_set") == number
        for name in key:
            held = held & F.col(name).isNotNull()
        counts += [
            F.coalesce(F.sum(F.when(held, F.col("_n"))), F.lit(0)).alias(f"_rows{order}"),
            F.count_if(held).alias(f"_keys{order}"),
            F.count_if(held & (F.col("_n") > 1)).alias(f"_more{order}"),
        ]
        structs.append(
            F.struct(
                F.lit(order).alias("_order"),
                F.lit(label).alias("Label"),
                F.lit(",".join(key)).alias("Key"),
                F.col(f"_rows{order}").alias("Rows"),
                F.col(f"_keys{order}").alias("Keys"),
                F.col(f"_more{order}").alias("Violations"),
            )
        )
    return groups.agg(*counts).select(F.inline(F.array(*structs)))
