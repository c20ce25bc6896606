"""Measurements joined to their station and item, and graded."""

from pyspark.sql import DataFrame, functions as F

from sensorloom.functions.columns import round_doubles
from sensorloom.functions.grading import grade
from sensorloom.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, HOT_ROWS, join_lookups
from sensorloom.schemas import THRESHOLDS


def enrich_measure(
    measurements: DataFrame,
    stations: DataFrame,
    items: DataFrame,
    decimals: int = 3,
    unknown_status: str | None = None,
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add station and item columns and a ``Status`` grade; keeps unmatched measurements.

    Doubles are rounded before grading. ``unknown_status`` labels rows that cannot be graded;
    without it they take the worst grade. See ``join_lookups`` for the last four arguments.
    """
    lookups = {"Station_Code": stations, "Item_Code": items}
    joined = join_lookups(measurements, lookups, hot_from, hot_rows, max_rows, max_bytes)
    graded = round_doubles(joined, decimals).withColumn(
        "Status", grade(F.col("Average_Value"), unknown_status)
    )
    ordered = ["Item_Code", "Station_Code"]
    rest = [c for c in graded.columns if c not in (*ordered, *THRESHOLDS)]
    return graded.select(*ordered, *[f"`{c}`" for c in rest])
