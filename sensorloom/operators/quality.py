"""Why readings were dropped, and what is wrong with an enriched table."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.functions.columns import parse_time, trim_strings
from sensorloom.operators.clean import clean_item, clean_station
from sensorloom.schemas import (
    BAD_DATE,
    BAD_INSTRUMENT_STATUS,
    INVALID_CODES,
    LATITUDE_RANGE,
    LONGITUDE_RANGE,
    MEASUREMENT_KEY,
    MISSING_VALUES,
    NEGATIVE_AVERAGE,
    RULES,
    TIME_FORMAT,
    UNRELIABLE_DATA,
)


MALFORMED_LINE = "Malformed line"


def removal_reason(
    measurements: DataFrame,
    time_column: str = "Measurement_Date",
    time_format: str | None = TIME_FORMAT,
    bad_statuses: Iterable[int] | None = BAD_INSTRUMENT_STATUS,
) -> Column:
    """The first rule a raw reading breaks, or NULL."""
    value = F.col("Average_Value")
    station, item = F.col("Station_Code"), F.col("Item_Code")
    bad_statuses = tuple(bad_statuses or ())
    reason = (
        F.when(parse_time(measurements, time_column, time_format).isNull(), BAD_DATE)
        .when(station.isNull() | item.isNull() | value.isNull(), MISSING_VALUES)
        .when(value < 0, NEGATIVE_AVERAGE)
        .when((station <= 0) | (item <= 0), INVALID_CODES)
    )
    if bad_statuses:
        unreliable = F.col("Instrument_Status").isin(*bad_statuses)
        reason = reason.when(unreliable, UNRELIABLE_DATA)
    return reason


def detect_errors(
    measurements: DataFrame,
    time_column: str = "Measurement_Date",
    time_format: str | None = TIME_FORMAT,
    bad_statuses: Iterable[int] | None = BAD_INSTRUMENT_STATUS,
) -> DataFrame:
    """Raw readings that break a rule, with the ``Removal_Reason``."""
    reason = removal_reason(measurements, time_column, time_format, bad_statuses)
    return measurements.withColumn("Removal_Reason", reason).filter(
        F.col("Removal_Reason").isNotNull()
    )


def error_counts(errors: DataFrame) -> DataFrame:
    """Errors per reason, most frequent first."""
    return errors.groupBy("Removal_Reason").count().orderBy(F.desc("count"), "Removal_Reason")


def _measure_outcomes(
    measurements: DataFrame, time_format: str | None, bad_statuses: Iterable[int] | None
) -> DataFrame:
    # Cleaning trims text before it reads the time; the account has to do the same.
    measurements, bad_statuses = trim_strings(measurements), tuple(bad_statuses or ())
    dropped = F.coalesce(
        removal_reason(
            measurements, time_format=time_format, bad_statuses=bad_statuses
        ),
        F.when(F.isnan("Average_Value"), "NaN value"),
        F.when(F.col("Instrument_Status").isNull(), "NULL instrument status")
        if bad_statuses
        else F.lit(None),
    )
    marked = measurements.withColumn(
        "Measurement_Date", parse_time(measurements, "Measurement_Date", time_format)
    ).withColumn("_dropped", dropped)
    # Keys of dropped rows are blanked so that those rows combine before the shuffle.
    kept_key = [F.when(F.col("_dropped").isNull(), F.col(k)).alias(k) for k in MEASUREMENT_KEY]
    per_key = (
        marked.select("_dropped", *kept_key)
        .groupBy("_dropped", *MEASUREMENT_KEY)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    per_reason = per_key.groupBy("_dropped").agg(
        F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_keys")
    )

    def line(outcome: Column, rows: Column) -> Column:
        return F.struct(outcome.alias("Outcome"), rows.alias("Rows"))

    raw = line(F.lit("Raw"), F.col("_rows"))
    lines = F.when(
        F.col("_dropped").isNull(),
        F.array(
            raw,
            line(F.lit("Duplicates"), F.col("_rows") - F.col("_keys")),
            line(F.lit("Clean"), F.col("_keys")),
        ),
    ).otherwise(F.array(raw, line(F.col("_dropped"), F.col("_rows"))))
    return (
        per_reason.select(F.inline(lines)).groupBy("Outcome").agg(F.sum("Rows").alias("Rows"))
    )


def clean_report(
    measurements: DataFrame,
    stations: DataFrame,
    items: DataFrame,
    time_format: str | None = TIME_FORMAT,
    bad_statuses: Iterable[int] | None = BAD_INSTRUMENT_STATUS,
    malformed: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Row counts per table before and after cleaning.

    For measurements every dropped row is accounted for: Raw = the reasons + NaN value +
    NULL instrument status + Duplicates + Clean. ``malformed`` has the source lines of tables that
    could not be read; they are part of Raw and, where there are any, a line of their own.
    """

    def counted(df: DataFrame, table: str, outcome: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("Rows")).select(
            F.lit(table).alias("Table"), F.lit(outcome).alias("Outcome"), "Rows"
        )

    report = _measure_outcomes(measurements, time_format, bad_statuses).select(
        F.lit("measurement").alias("Table"), "Outcome", "Rows"
    )
    for table, raw, clean in (
        ("station", stations, clean_station(stations)),
        ("item", items, clean_item(items)),
    ):
        report = report.union(counted(raw, table, "Raw")).union(counted(clean, table, "Clean"))
    if not malformed:
        return report
    for table, lines in malformed.items():
        unread = lines.agg(F.count(F.lit(1)).alias("Rows")).filter("Rows > 0")
        outcomes = F.explode(F.array(F.lit("Raw"), F.lit(MALFORMED_LINE))).alias("Outcome")
        report = report.union(unread.select(F.lit(table).alias("Table"), outcomes, "Rows"))
    return report.groupBy("Table", "Outcome").agg(F.sum("Rows").alias("Rows"))


def _any_null(*names: str) -> Column:
    condition = F.col(names[0]).isNull()
    for name in names[1:]:
        condition = condition | F.col(name).isNull()
    return condition


def _row_rules(
    bad_statuses: Iterable[int],
    latitude_range: tuple[float, float],
    longitude_range: tuple[float, float],
) -> dict[str, Column]:
    return {
        "Nulls": _any_null(*MEASUREMENT_KEY, "Average_Value"),
        "Missing_Station_Info": _any_null("Station_Name", "Latitude", "Longitude"),
        "Missing_Item_Info": _any_null("Item_Name", "Unit"),
        "Negative_Values": F.col("Average_Value") < 0,
        "Bad_Status": F.col("Instrument_Status").isin(*bad_statuses),
        "Bad_Latitude_Longitude": ~F.col("Latitude").between(*latitude_range)
        | ~F.col("Longitude").between(*longitude_range),
    }


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct fact codes without a lookup row; a NULL code counts as one.

    The codes are made distinct before they are looked up. An anti join would be planned below the
    distinct, where all rows of a code meet in one task.
    """
    seen = fact.select(key).distinct()
    known = dimension.select(key).distinct().withColumn("_known", F.lit(True))
    return seen.join(known, key, "left").filter(F.col("_known").isNull()).select(key)


def validation_details(
    enriched: DataFrame,
    stations: DataFrame,
    items: DataFrame,
    bad_statuses: Iterable[int] = BAD_INSTRUMENT_STATUS,
    latitude_range: tuple[float, float] = LATITUDE_RANGE,
    longitude_range: tuple[float, float] = LONGITUDE_RANGE,
) -> dict[str, DataFrame]:
    """For each rule the offending rows, keys or codes, as lazy tables."""
    bad_statuses = tuple(bad_statuses)
    details = {
        rule: enriched.filter(condition)
        for rule, condition in _row_rules(
            bad_statuses, latitude_range, longitude_range
        ).items()
    }
    details["Duplicates"] = duplicate_keys(enriched, MEASUREMENT_KEY)
    details["Orphan_Station"] = orphans(enriched, stations, "Station_Code")
    details["Orphan_Item"] = orphans(enriched, items, "Item_Code")
    return {rule: details[rule] for rule in RULES}


def validation_summary(
    enriched: DataFrame,
    stations: DataFrame,
    items: DataFrame,
    bad_statuses: Iterable[int] = BAD_INSTRUMENT_STATUS,
    latitude_range: tuple[float, float] = LATITUDE_RANGE,
    longitude_range: tuple[float, float] = LONGITUDE_RANGE,
) -> DataFrame:
    """Offences per rule in report order, as one job over one scan of the facts.

    Grouping sets make the groups of measurement keys, of station codes and of item codes in one
    pass; the groups of stations carry the counts of the six row rules. What follows has a row per
    code: the lookups are joined to it to tell the orphans.
    """
    row_rules = _row_rules(tuple(bad_statuses), latitude_range, longitude_range)
    flags = {rule: f"_rule{i}" for i, rule in enumerate(row_rules)}
    marked = enriched.select(
        *MEASUREMENT_KEY,
        *[F.coalesce(cond, F.lit(False)).cast("int").alias(flags[rule]) for rule, cond in row_rules.items()],
    )
    # Bits of the grouping id, one per key column, tell which columns a set leaves out.
    left_out = {
        name: sum(1 << i for i, key in enumerate(reversed(MEASUREMENT_KEY)) if key != name)
        for name in ("Station_Code", "Item_Code")
    }
    groups = marked.groupingSets(
        [list(MEASUREMENT_KEY), ["Station_Code"], ["Item_Code"]], *MEASUREMENT_KEY
    ).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(flag).alias(flag) for flag in flags.values()],
    )
    of_stations, of_items = (F.col("_set") == left_out[name] for name in ("Station_Code", "Item_Code"))
    code = F.when(of_stations, F.col("Station_Code")).when(of_items, F.col("Item_Code"))
    per_code = groups.groupBy("_set", code.alias("_code")).agg(
        F.count_if(F.col("_rows") > 1).alias("_repeated"),
        *[F.sum(flag).alias(flag) for flag in flags.values()],
    )
    known = None
    for name, table in (("Station_Code", stations), ("Item_Code", items)):
        codes = table.select(F.lit(left_out[name]).cast("bigint").alias("_set"), F.col(name).alias("_code"))
        known = codes if known is None else known.union(codes)
    known = known.distinct().withColumn("_known", F.lit(True))
    orphan = F.col("_known").isNull()
    totals = per_code.join(known, ["_set", "_code"], "left").agg(
        *[F.sum(F.when(of_stations, F.col(flags[rule]))).alias(rule) for rule in row_rules],
        F.sum(F.when(F.col("_set") == 0, F.col("_repeated"))).alias("Duplicates"),
        F.count_if(of_stations & orphan).alias("Orphan_Station"),
        F.count_if(of_items & orphan).alias("Orphan_Item"),
    )
    lines = [
        F.struct(
            F.lit(order).alias("_order"),
            F.lit(rule).alias("Rule_ID"),
            F.coalesce(F.col(rule), F.lit(0)).cast("bigint").alias("Validations"),
        )
        for order, rule in enumerate(RULES)
    ]
    return totals.select(F.inline(F.array(*lines))).orderBy("_order").select("Rule_ID", "Validations")
