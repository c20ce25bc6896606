"""Results that a stream keeps up to date at the cost of each micro-batch.

The state of a result is a table of partial results that merge in any order: the latest reading per
station and item, and count, sum and range per item name and grade. A micro-batch is reduced to its
own partial results and merged into the stored ones of the same buckets; its number makes that
happen once. Both results change together.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.operators.dedup import first_per_key
from sensorloom.sources.store import PieceStore

# Into how many buckets the state is dealt by its keys.
BUCKETS = 32
PAIR, GROUP = ["Station_Code", "Item_Code"], ["Item_Name", "Status"]


def _bucketed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.withColumn("Bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))


def _latest(rows: DataFrame) -> DataFrame:
    """The last reading by time of each station and item; of one time the highest."""
    return first_per_key(rows, PAIR, order=["Measurement_Date"], last=True)


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP, "Bucket").agg(
        F.sum("Count").alias("Count"),
        F.sum("Sum").alias("Sum"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    ).select(*GROUP, "Count", "Sum", "min_value", "max_value", "Bucket")


def take_batch(enriched: DataFrame, folder: str, batch_id: int) -> bool:
    """Merge a micro-batch of enriched readings into the results kept in ``folder``; False if it has
    been merged already. Rows without a time have no place in the latest readings, rows without a
    value none in the totals."""
    change = PieceStore(enriched.sparkSession, folder).begin(batch_id)
    if change is None:
        return False
    rows = change.stage(
        enriched.select(
            "Measurement_Date", *PAIR, "Average_Value", "Instrument_Status", "Status", "Item_Name", "Station_Name"
        )
    )
    dated = rows.filter(F.col("Measurement_Date").isNotNull())
    change.merge("latest", _bucketed(dated, PAIR), PAIR, "Bucket", _latest)
    value = F.col("Average_Value")
    valued = rows.filter(value.isNotNull()).select(
        *GROUP,
        F.lit(1).cast("bigint").alias("Count"),
        value.alias("Sum"),
        value.alias("min_value"),
        value.alias("max_value"),
    )
    change.merge("totals", _bucketed(valued, GROUP), GROUP, "Bucket", _totals)
    change.commit()
    return True


def results_stream(enriched: DataFrame, folder: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Keep the results of a stream of enriched readings. No state grows in the query itself; one
    stream writes to a folder."""
    writer = enriched.writeStream.foreachBatch(
        lambda batch, batch_id: take_batch(batch, folder, batch_id)
    ).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_latest(spark: SparkSession, folder: str) -> DataFrame | None:
    """The latest reading per station and item, None before the first micro-batch."""
    found = PieceStore(spark, folder).read("latest")
    return None if found is None else found.drop("Bucket")


def read_totals(spark: SparkSession, folder: str) -> DataFrame | None:
    """The columns of ``item_status_stats``, None before the first micro-batch."""
    found = PieceStore(spark, folder).read("totals")
    if found is None:
        return None
    mean = F.try_divide("Sum", "Count").alias("avg_value")
    return found.select(*GROUP, "Count", mean, "min_value", "max_value")
