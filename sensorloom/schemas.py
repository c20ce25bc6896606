"""Names, types and constants of the sensor tables."""

from collections.abc import Mapping

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# For each source table the header, the column it becomes and its type.
MEASUREMENT = (
    ("Measurement date", "Measurement_Date", "timestamp"),
    ("Station code", "Station_Code", "int"),
    ("Item code", "Item_Code", "int"),
    ("Average value", "Average_Value", "double"),
    ("Instrument status", "Instrument_Status", "int"),
)
STATION = (
    ("Station code", "Station_Code", "int"),
    ("Station name(district)", "Station_Name", "string"),
    ("Latitude", "Latitude", "double"),
    ("Longitude", "Longitude", "double"),
)
ITEM = (
    ("Item code", "Item_Code", "int"),
    ("Item name", "Item_Name", "string"),
    ("Unit of measurement", "Unit", "string"),
)


def declared(spec: tuple[tuple[str, str, str], ...]) -> list[str]:
    """The column names that a table specification declares."""
    return [name for _, name, _ in spec]


# Threshold columns of the item table, lowest bound first.
THRESHOLDS = ("Good(Blue)", "Normal(Green)", "Bad(Yellow)", "Very bad(Red)")

# The document fields that hold the thresholds.
THRESHOLD_FIELDS = ("good", "normal", "bad", "very_bad")

# Grades from best to worst.
GRADES = ("Good", "Normal", "Bad", "Very Bad")

# Instrument states that make a reading unreliable.
BAD_INSTRUMENT_STATUS = (2, 4, 8, 9)

# Why a raw reading is removed, by priority.
BAD_DATE = "Bad date"
MISSING_VALUES = "Missing values"
NEGATIVE_AVERAGE = "Negative average"
INVALID_CODES = "Invalid codes"
UNRELIABLE_DATA = "Unreliable data"

# The validation rules in report order.
RULES = (
    "Duplicates",
    "Nulls",
    "Missing_Station_Info",
    "Missing_Item_Info",
    "Orphan_Station",
    "Orphan_Item",
    "Negative_Values",
    "Bad_Status",
    "Bad_Latitude_Longitude",
)

# Text form of a measurement time.
TIME_FORMAT = "yyyy-MM-dd HH:mm"

LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)

MEASUREMENT_KEY = ("Measurement_Date", "Station_Code", "Item_Code")

# Station and item codes as bigint, for tables whose keys outgrow an int.
WIDE_CODES = {"Station_Code": "bigint", "Item_Code": "bigint"}

def enriched_schema(types: Mapping[str, str] | None = None) -> StructType:
    """The schema of stored results; ``types`` overrides single types, as it does in ``recast``."""
    types = types or {}
    return StructType(
        [
            StructField(f.name, _parse(types[f.name]) if f.name in types else f.dataType)
            for f in ENRICHED.fields
        ]
    )


def _parse(name: str) -> DataType:
    return StructType.fromDDL(f"c {name}").fields[0].dataType


ENRICHED = StructType(
    [
        StructField("Item_Code", IntegerType()),
        StructField("Station_Code", IntegerType()),
        StructField("Measurement_Date", TimestampType()),
        StructField("Average_Value", DoubleType()),
        StructField("Instrument_Status", IntegerType()),
        StructField("Station_Name", StringType()),
        StructField("Latitude", DoubleType()),
        StructField("Longitude", DoubleType()),
        StructField("Address", StringType()),
        StructField("Item_Name", StringType()),
        StructField("Unit", StringType()),
        StructField("Status", StringType()),
    ]
)
