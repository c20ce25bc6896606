"""Reports over enriched measurements; all but the sorted ones also run on a stream."""

from pyspark.sql import DataFrame, Window, functions as F

from sensorloom.functions.columns import parse_time
from sensorloom.functions.grading import grade_rank


def zero_values(measurements: DataFrame) -> DataFrame:
    """Readings of exactly zero, for inspection."""
    return measurements.filter(F.col("Average_Value") == 0)


# The names and order of the columns below are those that consumers of the totals read.
def item_status_stats(enriched: DataFrame) -> DataFrame:
    """Count, mean and range of the values per item name and grade."""
    value = F.col("Average_Value")
    return (
        enriched.filter(value.isNotNull())
        .groupBy("Item_Name", "Status")
        .agg(
            F.count(F.lit(1)).alias("Count"),
            F.avg(value).alias("avg_value"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
        )
    )


def item_status_pretty(stats: DataFrame) -> DataFrame:
    """The statistics as a printed report: grades from best to worst under each item, the item
    named on its first line only.

    The window runs on aggregated rows, at most one per grade in each item.
    """
    rank = grade_rank(F.col("Status"))
    within_item = Window.partitionBy("Item_Name").orderBy("_rank", "Status")
    return (
        stats.withColumn("_rank", rank)
        .withColumn("_line", F.row_number().over(within_item))
        .orderBy("Item_Name", "_rank", "Status")
        .select(
            F.when(F.col("_line") == 1, F.col("Item_Name")).otherwise("").alias("Item"),
            "Status",
            "Count",
            F.round("avg_value", 3).alias("Average"),
            F.col("min_value").alias("Min_Value"),
            F.col("max_value").alias("Max_Value"),
        )
    )


def bad_records(enriched: DataFrame) -> DataFrame:
    """Readings graded exactly ``Bad``."""
    return enriched.filter(F.col("Status") == "Bad").select(
        parse_time(enriched, "Measurement_Date", None).alias("Measurement_Date"),
        "Item_Code",
        "Item_Name",
        "Station_Name",
        F.col("Average_Value").alias("Value"),
        "Status",
    )


def bad_records_hourly(enriched: DataFrame) -> DataFrame:
    """Readings graded exactly ``Bad``, with the hour they fall in."""
    return enriched.filter(F.col("Status") == "Bad").select(
        F.date_trunc("hour", parse_time(enriched, "Measurement_Date", None)).alias("Hour"),
        "Item_Code",
        "Item_Name",
        "Station_Name",
        F.col("Average_Value").alias("Value"),
    )
