"""The sensor inputs read from the benchmark tables.

lineitem plays the measurements, supplier the stations and part the items. Each is read whole.
The faults that cleaning looks for come from plain data conditions: some quantities stand for a
missing or damaged field, supplier 0 has an invalid code, large balances lie off the globe.
Readings move in steps of a quarter, so that sums of them are exact in any order.
"""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.functions.columns import recast, round_doubles
from sensorloom.operators.clean import (
    clean_item,
    clean_measure,
    clean_station,
    valid_measurements,
)
from sensorloom.operators.enrich import enrich_measure
from sensorloom.operators.graph import Graph, build_graph
from sensorloom.operators.joins import join_small
from sensorloom.schemas import ITEM, MEASUREMENT, STATION, TIME_FORMAT, WIDE_CODES
from sensorloom.sources.files import shared_folder


def measurement_source(lineitem: DataFrame) -> DataFrame:
    """Typed measurements under their source headers."""
    quantity = F.col("l_quantity")
    hours = F.round(F.col("l_discount") * 100).cast("int")
    time = F.col("l_shipdate") + F.make_dt_interval(hours=hours)
    value = (F.floor(F.col("l_extendedprice") / 250) - 3) / 4
    return lineitem.select(
        F.when(quantity != 3, time).alias("Measurement date"),
        F.when(quantity == 23, -F.col("l_suppkey"))
        .when(quantity != 7, F.col("l_suppkey"))
        .alias("Station code"),
        F.when(quantity == 29, -F.col("l_linenumber"))
        .when(quantity != 11, F.col("l_linenumber"))
        .alias("Item code"),
        F.when(quantity == 17, F.lit(float("nan")))
        .when(quantity == 19, -value - 0.25)
        .when(quantity != 13, value)
        .alias("Average value"),
        F.when(quantity != 31, F.round(F.col("l_tax") * 100).cast("int")).alias(
            "Instrument status"
        ),
    )


def measurement_text(lineitem: DataFrame) -> DataFrame:
    """The same measurements as text: some dates in another format, some codes as decimals."""
    typed = measurement_source(lineitem)
    time, station = F.col("`Measurement date`"), F.col("`Station code`").cast("string")
    item = F.col("`Item code`").cast("string")
    return typed.select(
        F.when(F.hour(time) == 0, F.date_format(time, "yyyy/MM/dd"))
        .otherwise(F.date_format(time, TIME_FORMAT))
        .alias("Measurement date"),
        F.when(F.col("`Item code`") == 2, F.concat(station, F.lit(".0")))
        .otherwise(station)
        .alias("Station code"),
        item.alias("Item code"),
        F.col("`Average value`").cast("string").alias("Average value"),
        F.col("`Instrument status`").cast("string").alias("Instrument status"),
    )


def station_source(supplier: DataFrame) -> DataFrame:
    """Stations under their source headers, with padded names."""
    return supplier.select(
        F.col("s_suppkey").alias("Station code"),
        F.when(
            F.col("s_nationkey") != 24, F.concat(F.lit("  "), F.col("s_name"), F.lit(" "))
        ).alias("Station name(district)"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("Address"),
        (F.col("s_acctbal") / 100).alias("Latitude"),
        (F.col("s_acctbal") / 50).alias("Longitude"),
    )


def item_source(part: DataFrame) -> DataFrame:
    """Items under their source headers, with padded names and thresholds."""
    size = F.col("p_size").cast("double")
    return part.select(
        F.col("p_partkey").alias("Item code"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("Item name"),
        F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("Unit of measurement"),
        size.alias("Good(Blue)"),
        (size + 25).alias("Normal(Green)"),
        (size + 50).alias("Bad(Yellow)"),
        (size + 75).alias("Very bad(Red)"),
    )


@dataclass(frozen=True)
class Tables:
    """The stages of the batch pipeline over one folder of tables, each a lazy DataFrame."""

    spark: SparkSession
    folder: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def measurement_raw(self) -> DataFrame:
        return recast(measurement_source(self.read("lineitem")), MEASUREMENT, WIDE_CODES)

    @cached_property
    def station_source(self) -> DataFrame:
        return station_source(self.read("supplier"))

    @cached_property
    def item_source(self) -> DataFrame:
        return item_source(self.read("part"))

    @cached_property
    def station_raw(self) -> DataFrame:
        return recast(self.station_source, STATION, WIDE_CODES)

    @cached_property
    def item_raw(self) -> DataFrame:
        return recast(self.item_source, ITEM, WIDE_CODES)

    @cached_property
    def station(self) -> DataFrame:
        return clean_station(self.station_raw)

    @cached_property
    def item(self) -> DataFrame:
        return clean_item(self.item_raw)

    @cached_property
    def measurement(self) -> DataFrame:
        return clean_measure(self.measurement_raw)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich_measure(
            self.measurement, self.station, self.item, hot_from=self.measurement_raw
        )

    @cached_property
    def enriched_raw(self) -> DataFrame:
        """Uncleaned facts and lookups joined, on which every validation rule can fire."""
        return enrich_measure(self.measurement_raw, self.station_raw, self.item_raw)

    @cached_property
    def first_readings(self) -> DataFrame:
        """When each station first measured each item, with the properties of both.

        Deduplication keeps a reading of every time, so the valid rows give the same answer
        without it, and the measurements are not shuffled.
        """
        first = (
            valid_measurements(self.measurement_raw)
            .groupBy("Station_Code", "Item_Code")
            .agg(F.min("Measurement_Date").alias("Measurement_Date"))
        )
        lookups = {"Station_Code": self.station, "Item_Code": self.item}
        return round_doubles(join_small(first, lookups), 3)

    @cached_property
    def graph(self) -> Graph:
        """The graph, with the properties of stations and items from the first readings, which
        are written once for both."""
        folder = shared_folder(self.spark, "properties")
        return build_graph(self.enriched, folder=folder, described=self.first_readings)

    @cached_property
    def written_graph(self) -> Graph:
        """The graph, with all its measurements, statuses and times from one pass."""
        return build_graph(
            self.enriched,
            folder=shared_folder(self.spark, "properties"),
            described=self.first_readings,
            writes_folder=shared_folder(self.spark, "writes"),
        )

    @cached_property
    def lazy_graph(self) -> Graph:
        """The graph, for uses without its stations and items."""
        return build_graph(self.enriched)
