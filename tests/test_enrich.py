from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorloom.operators.enrich import enrich_measure
from sensorloom.operators.joins import (
    _salted_join,
    fits_broadcast,
    frequent_values,
    join_lookups,
)
from sensorloom.operators.quality import RULES, orphans, validation_details, validation_summary

T = datetime(2020, 1, 1, 5)


@pytest.fixture(scope="module")
def tables(spark):
    measure = spark.createDataFrame(
        [
            (T, 1, 1, 1.00049, 0),
            (T, 1, 2, 2.5, 2),
            (T, 9, 1, 30.0, 0),
            (T, None, 1, 1.0, 0),
            (T, None, 1, 2.0, 0),
            (T, 1, 7, 1.0, 0),
            (T, 2, 1, -5.0, 4),
            (T, 2, 1, None, 0),
        ],
        "Measurement_Date timestamp, Station_Code int, Item_Code int, Average_Value double, "
        "Instrument_Status int",
    )
    station = spark.createDataFrame(
        [(1, "one", 1.23456, 2.0, "a"), (2, "two", None, 200.0, "b"), (3, "x", None, 0.0, "c")],
        "Station_Code int, Station_Name string, Latitude double, Longitude double, Address string",
    )
    item = spark.createDataFrame(
        [(1, "SO2", "ppm", 1.0, 2.0, 3.0, 4.0), (2, "CO", "ppm", 1.0, 2.0, 3.0, 4.0)],
        "Item_Code int, Item_Name string, Unit string, `Good(Blue)` double, "
        "`Normal(Green)` double, `Bad(Yellow)` double, `Very bad(Red)` double",
    )
    return measure, station, item


def test_enrich(tables):
    out = enrich_measure(*tables)
    assert out.columns == [
        "Item_Code", "Station_Code", "Measurement_Date", "Average_Value", "Instrument_Status",
        "Station_Name", "Latitude", "Longitude", "Address", "Item_Name", "Unit", "Status",
    ]
    rows = {(r["Station_Code"], r["Item_Code"], r["Average_Value"]): r for r in out.collect()}
    assert len(rows) == 8
    # 1.00049 rounds to 1.0, which is still Good
    assert rows[1, 1, 1.0]["Status"] == "Good"
    assert rows[1, 1, 1.0]["Latitude"] == 1.235
    assert rows[1, 2, 2.5]["Status"] == "Bad"
    assert rows[9, 1, 30.0]["Station_Name"] is None
    assert rows[1, 7, 1.0]["Status"] == rows[2, 1, None]["Status"] == "Very Bad"
    labelled = enrich_measure(*tables, unknown_status="Unknown")
    assert labelled.filter("Status = 'Unknown'").count() == 2


def test_large_lookups_give_the_same_rows(tables):
    small = sorted(enrich_measure(*tables).collect(), key=str)
    for max_rows in (0, 1, 2):
        for hot_rows in (1, 2, 100):
            large = enrich_measure(*tables, max_rows=max_rows, hot_rows=hot_rows).collect()
            assert sorted(large, key=str) == small


def skewed(spark):
    # A third of the rows share one key, and a tenth have none.
    i = F.col("id")
    key = F.when(i < 4000, F.lit(7)).when(i < 5200, F.lit(None)).otherwise(i.cast("int"))
    fact = spark.range(12000).select(i, key.alias("k"))
    lookup = spark.range(0, 20000, 2).select(F.col("id").cast("int").alias("k"), i.alias("v"))
    return fact, lookup.union(lookup.filter("k = 6000")).union(spark.sql("SELECT 7, 1L"))


def test_skewed_key_stays_out_of_the_shuffle(spark):
    fact, lookup = skewed(spark)
    expected = sorted(fact.join(lookup, "k", "left").collect(), key=str)
    joined = join_lookups(fact, {"k": lookup}, max_rows=100, hot_rows=1000)
    assert sorted(joined.collect(), key=str) == expected
    assert frequent_values(fact, "k", 1000) == [7]
    assert frequent_values(fact, "k") == []
    light = fact.filter("k IS NOT NULL AND k <> 7").groupBy("k").count()
    assert light.agg(F.max("count")).first()[0] == 1
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_hot_keys_may_come_from_another_table(spark):
    fact, lookup = skewed(spark)
    joined = join_lookups(fact, {"k": lookup}, hot_from=spark.range(3).select(F.lit(9).alias("k")), hot_rows=2, max_rows=100)
    assert joined.count() == fact.join(lookup, "k", "left").count()


def test_repeated_lookup_rows_of_a_hot_key_are_not_broadcast_unchecked(spark):
    fact = spark.range(50).select(F.lit(1).alias("k"), "id")
    lookup = spark.range(40).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    joined = join_lookups(fact, {"k": lookup}, max_rows=10, hot_rows=5)
    assert joined.count() == 2000


def test_size_check_counts_rows_and_bytes(spark):
    df = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("s"))
    assert fits_broadcast(df, df.limit(0)) == [True, True]
    assert fits_broadcast(df, max_rows=9) == [False]
    assert fits_broadcast(df, df.select("id"), max_bytes=9000) == [False, True]
    nested = df.select(F.array("s", "s").alias("a"), F.col("s").cast("binary").alias("b"))
    assert fits_broadcast(nested, max_bytes=29000) == [False]


def test_hot_keys_are_bounded_by_their_share(spark):
    df = spark.range(100).select(F.sqrt("id").cast("int").alias("k"))
    assert frequent_values(df, "k", 5) == [2, 3, 4, 5, 6, 7, 8, 9]
    assert frequent_values(df, "k", 5, share=0.16) == [8, 9]
    assert frequent_values(df.limit(0), "k", 1) == []


def test_one_pass_over_the_fact_with_hot_lookup_rows_above_the_bound(spark):
    fact, lookup = skewed(spark)
    joined = join_lookups(fact, {"k": lookup}, max_rows=0, hot_rows=1)
    expected = fact.join(lookup, "k", "left")
    assert joined.exceptAll(expected).count() == expected.exceptAll(joined).count() == 0
    hot = _salted_join(fact, lookup, "k", [7], salts=16).withColumn("p", F.spark_partition_id())
    most = hot.filter("k = 7 OR k IS NULL").groupBy("p").count().agg(F.max("count")).first()[0]
    assert most < 3000  # of 5,200 hot and NULL rows
    assert joined.columns == ["k", "id", "v"]


def test_salt_column_clashes_with_none(spark):
    fact = spark.range(9).select(F.lit(1).alias("k"), F.col("id").alias("_salt"))
    lookup = spark.sql("SELECT 1 AS k, 'x' AS _salt_")
    joined = join_lookups(fact, {"k": lookup}, max_rows=0, hot_rows=1)
    assert joined.columns == ["k", "_salt", "_salt_"] and joined.count() == 9


def test_validation(tables):
    measure, station, item = tables
    enriched = enrich_measure(*tables)
    details = validation_details(enriched, station, item)
    summary = validation_summary(enriched, station, item).collect()
    assert [r["Rule_ID"] for r in summary] == list(RULES)
    counts = {r["Rule_ID"]: r["Validations"] for r in summary}
    assert counts == {rule: details[rule].count() for rule in RULES}
    assert counts == {
        "Duplicates": 2,
        "Nulls": 3,
        "Missing_Station_Info": 5,
        "Missing_Item_Info": 1,
        "Orphan_Station": 2,  # 9, and NULL counted once
        "Orphan_Item": 1,
        "Negative_Values": 1,
        "Bad_Status": 2,
        "Bad_Latitude_Longitude": 2,  # a NULL latitude beside a bad longitude still counts
    }


def test_null_coordinates_alone_are_not_out_of_range(spark, tables):
    measure, _, item = tables
    station = spark.createDataFrame(
        [(1, "one", None, 0.0, "a")],
        "Station_Code int, Station_Name string, Latitude double, Longitude double, Address string",
    )
    enriched = enrich_measure(measure, station, item)
    assert validation_details(enriched, station, item)["Bad_Latitude_Longitude"].count() == 0


def test_validation_of_nothing(tables):
    measure, station, item = tables
    enriched = enrich_measure(measure.limit(0), station, item)
    assert [r["Validations"] for r in validation_summary(enriched, station, item).collect()] == [0] * 9


def test_orphans_are_looked_up_once_per_code(spark, tmp_path):
    """The lookup comes above the distinct, so that no task sorts all rows of a frequent code."""
    fact = spark.createDataFrame([(1,), (1,), (2,), (2,), (None,), (None,)], "Item_Code bigint")
    items = spark.createDataFrame([(1,), (1,), (None,)], "Item_Code bigint")
    for name, table in (("fact", fact), ("items", items)):
        table.write.parquet(f"{tmp_path}/{name}")
    fact, items = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("fact", "items"))
    found = orphans(fact, items, "Item_Code")
    assert sorted(found.collect(), key=repr) == sorted([(2,), (None,)], key=repr)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")
