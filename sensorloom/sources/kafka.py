"""Kafka as source and sink of JSON messages.

Needs Spark's Kafka connector on the class path. The encoding and decoding of the messages lies
in ``sensorloom.functions.messages`` and works on any table with a ``value`` column.
"""

from pyspark.sql import DataFrame, SparkSession


def source_options(
    servers: str, topic: str, starting_offsets: str = "earliest", fail_on_data_loss: bool = False
) -> dict[str, str]:
    """Options of the stream reader."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Messages of a topic as an unbounded table with a binary ``value``."""
    chosen = source_options(servers, topic, **options)
    return spark.readStream.format("kafka").options(**chosen).load()


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a table of messages to a topic, acknowledged by all replicas."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.linger.ms", "50")
        .option("topic", topic)
        .save()
    )
