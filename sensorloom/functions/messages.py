"""Rows as JSON messages and back."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from sensorloom.functions.columns import column


def to_messages(df: DataFrame, limit: int | None = None) -> DataFrame:
    """One JSON object per row in a ``value`` column; every field is written, NULL included."""
    rows = df if limit is None else df.limit(limit)
    fields = F.struct(*[column(c) for c in df.columns])
    return rows.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def decode_messages(messages: DataFrame, schema: StructType, plain_nan: bool = False) -> DataFrame:
    """Flatten the JSON in ``value`` (text or bytes) to the columns of ``schema``.

    A bare NaN token reaches a string field with quotes around it; ``plain_nan`` removes them,
    so that a later cast to double gives NaN instead of NULL.
    """
    if not schema.fields:
        raise ValueError("no schema: the message fields must be known to decode them")
    parsed = messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data"))
    out = []
    for field in schema.fields:
        value = F.col("data").getField(field.name)
        if plain_nan and field.dataType.simpleString() == "string":
            value = F.when(value == '"NaN"', F.lit("NaN")).otherwise(value)
        out.append(value.alias(field.name))
    return parsed.select(*out)
