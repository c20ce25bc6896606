"""Shaping whole tables column by column, always in a single projection."""

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, TimestampNTZType, TimestampType


def column(name: str) -> Column:
    """The column called ``name``, which may hold spaces, dots or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def lenient_cast(value: Column, source: DataType, target: str) -> Column:
    """Cast that gives NULL where the value does not fit.

    Whole numbers written with a fraction ("4.0") become integers.
    """
    if target in ("int", "bigint") and isinstance(source, StringType):
        return F.coalesce(value.try_cast(target), value.try_cast("double").try_cast(target))
    return value.try_cast(target)


def recast(
    df: DataFrame,
    spec: Iterable[tuple[str, str, str]],
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rename headers and cast to the declared types.

    ``spec`` lists (header, name, type). Declared columns come first, a missing one as a typed
    NULL; all other columns follow unchanged. ``types`` overrides single types.
    """
    types = types or {}
    present = set(df.columns)
    used, selected = set(), []
    for header, name, declared in spec:
        target = types.get(name, declared)
        source = name if name in present else header
        used |= {name, header}
        if source in present:
            value = lenient_cast(column(source), df.schema[source].dataType, target)
        else:
            value = F.lit(None).cast(target)
        selected.append(value.alias(name))
    extras = [column(c) for c in df.columns if c not in used]
    return df.select(*selected, *extras)


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip leading and trailing spaces (only spaces) from every string column."""
    return df.select(
        *[
            F.trim(column(f.name)).alias(f.name)
            if isinstance(f.dataType, StringType)
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def round_doubles(df: DataFrame, decimals: int) -> DataFrame:
    """Round every double column, half away from zero."""
    return df.select(
        *[
            F.round(column(f.name), decimals).alias(f.name)
            if isinstance(f.dataType, DoubleType)
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def safe_names(names: Iterable[str]) -> list[str]:
    """Names of letters, digits and underscores only, kept distinct by a numeric suffix."""
    taken: set[str] = set()
    out = []
    for name in names:
        base = re.sub(r"[^A-Za-z0-9_]", "_", name)
        candidate, n = base, 2
        while candidate.lower() in taken:
            candidate, n = f"{base}_{n}", n + 1
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename columns so that downstream SQL and file formats take them unquoted."""
    return df.toDF(*safe_names(df.columns))


def parse_time(df: DataFrame, name: str, time_format: str | None) -> Column:
    """The time column as a timestamp; text that does not match the format gives NULL."""
    source = df.schema[name].dataType
    if isinstance(source, TimestampType):
        return column(name)
    if isinstance(source, StringType) and time_format:
        return F.try_to_timestamp(column(name), F.lit(time_format))
    if isinstance(source, TimestampNTZType):
        return column(name).cast("timestamp")
    return column(name).try_cast("timestamp")
