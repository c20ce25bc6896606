"""Nested documents for items, stations and measurements, and the queries over them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.functions.columns import column, lenient_cast, parse_time
from sensorloom.operators.dedup import first_per_key
from sensorloom.operators.joins import join_small
from sensorloom.schemas import THRESHOLD_FIELDS, THRESHOLDS, TIME_FORMAT


def _cast(df: DataFrame, name: str, target: str) -> Column:
    return lenient_cast(column(name), df.schema[name].dataType, target)


def item_documents(items: DataFrame, code_type: str = "int") -> DataFrame:
    """Item source rows as documents with nested thresholds; rows without a code are skipped."""
    bounds = F.struct(
        *[
            _cast(items, name, "double").alias(field)
            for name, field in zip(THRESHOLDS, THRESHOLD_FIELDS)
        ]
    )
    return items.select(
        _cast(items, "Item code", code_type).alias("_id"),
        _cast(items, "Item name", "string").alias("name"),
        _cast(items, "Unit of measurement", "string").alias("unit"),
        bounds.alias("thresholds"),
    ).filter(F.col("_id").isNotNull())


def station_documents(stations: DataFrame, code_type: str = "int") -> DataFrame:
    """Station source rows as documents with a GeoJSON point, longitude first.

    ``location`` is NULL unless both coordinates are known; rows without a code are skipped.
    """
    latitude = _cast(stations, "Latitude", "double")
    longitude = _cast(stations, "Longitude", "double")
    point = F.struct(
        F.lit("Point").alias("type"), F.array(longitude, latitude).alias("coordinates")
    )
    return stations.select(
        _cast(stations, "Station code", code_type).alias("_id"),
        _cast(stations, "Station name(district)", "string").alias("name"),
        _cast(stations, "Address", "string").alias("address"),
        F.when(latitude.isNotNull() & longitude.isNotNull(), point).alias("location"),
    ).filter(F.col("_id").isNotNull())


def measurement_documents(enriched: DataFrame, code_type: str = "int") -> DataFrame:
    """Enriched measurements as time-series documents; rows without a time are skipped."""
    return enriched.select(
        parse_time(enriched, "Measurement_Date", None).alias("ts"),
        _cast(enriched, "Average_Value", "double").alias("avg"),
        _cast(enriched, "Instrument_Status", "int").alias("instrument_status"),
        _cast(enriched, "Status", "string").alias("status"),
        F.struct(
            _cast(enriched, "Station_Code", code_type).alias("station_code"),
            _cast(enriched, "Item_Code", code_type).alias("item_code"),
        ).alias("meta"),
    ).filter(F.col("ts").isNotNull())


def insert_ignore(
    incoming: DataFrame,
    existing: DataFrame | None = None,
    key: str = "_id",
    order: Sequence[str] = (),
) -> DataFrame:
    """The incoming documents an insert would add: the first per key, unless the key exists."""
    fresh = first_per_key(incoming, [key], order)
    return fresh if existing is None else fresh.join(existing.select(key), key, "left_anti")


def insert_counts(
    incoming: DataFrame, existing: DataFrame | None = None, key: str = "_id"
) -> DataFrame:
    """How many documents an insert would attempt, add and ignore."""
    per_key = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    if existing is None:
        marked = per_key.withColumn("_known", F.lit(None))
    else:
        known = existing.select(key).distinct().withColumn("_known", F.lit(True))
        marked = per_key.join(known, key, "left")
    total = F.coalesce(F.sum("_rows"), F.lit(0))
    added = F.count_if(F.col("_known").isNull())
    return marked.agg(
        total.alias("Attempted"), added.alias("Inserted"), (total - added).alias("Ignored")
    )


def _names(documents: DataFrame, code: str, name: str) -> DataFrame:
    return first_per_key(
        documents.select(F.col("_id").alias(code), F.col("name").alias(name)), [code]
    )


def _flat(measurements: DataFrame) -> DataFrame:
    return measurements.select(
        "ts",
        F.col("meta.station_code").alias("station_code"),
        F.col("meta.item_code").alias("item_code"),
        "avg",
        "instrument_status",
        "status",
    )


def latest_snapshot(
    measurements: DataFrame, items: DataFrame, stations: DataFrame
) -> DataFrame:
    """The latest document per station and item, with the names looked up.

    The pick comes before the lookups, so they join one row per station and item. Documents of
    the same time are told apart by their highest reading.
    """
    latest = first_per_key(
        _flat(measurements), ["station_code", "item_code"], order=["ts"], last=True
    )
    named = join_small(
        latest,
        {
            "item_code": _names(items, "item_code", "item_name"),
            "station_code": _names(stations, "station_code", "station_name"),
        },
    )
    return named.select(
        F.date_format("ts", TIME_FORMAT).alias("Datetime"),
        F.col("station_code").alias("Station Code"),
        F.col("station_name").alias("Station Name"),
        F.col("item_code").alias("Item Code"),
        F.col("item_name").alias("Item Name"),
        F.col("avg").alias("Value"),
        F.col("status").alias("Status"),
    )


def latest_snapshot_report(snapshot: DataFrame) -> DataFrame:
    """The snapshot by item name, highest value first; unnamed items are left out."""
    return snapshot.filter(column("Item Name").isNotNull()).orderBy(
        column("Item Name"), F.desc("Value"), column("Station Code"), column("Item Code")
    )


def historical_trend(
    measurements: DataFrame,
    items: DataFrame,
    stations: DataFrame,
    item_code: int,
    station_code: int,
) -> DataFrame:
    """All readings of one item at one station in time order, one row per time.

    The point filter reaches the scan. Each name table is cut to a single code first and holds
    at most one row, so broadcasting it is safe at any size.
    """
    matched = _flat(measurements).filter(
        (F.col("item_code") == item_code) & (F.col("station_code") == station_code)
    )
    rows = first_per_key(matched, ["ts", "station_code", "item_code"])
    item = _names(items.filter(F.col("_id") == item_code), "item_code", "item_name")
    station = _names(
        stations.filter(F.col("_id") == station_code), "station_code", "station_name"
    )
    return (
        rows.join(F.broadcast(item), "item_code", "left")
        .join(F.broadcast(station), "station_code", "left")
        .orderBy("ts")
        .select(
            F.date_format("ts", TIME_FORMAT).alias("Datetime"),
            F.col("station_name").alias("Station Name"),
            F.col("item_name").alias("Item Name"),
            F.col("avg").alias("Value"),
            F.col("status").alias("Status"),
        )
    )


def history_head(history: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of a history by time, with the text time parsed (NULL if unreadable)."""
    return (
        history.withColumn(
            "Datetime", F.try_to_timestamp(F.col("Datetime"), F.lit(TIME_FORMAT))
        )
        .orderBy("Datetime", "Value", "Status")
        .limit(n)
    )
