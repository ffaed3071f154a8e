"""Event messages from a topic or from files, and back to a topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.operators.summary import COLD_USER

# Name of the topic, address used in development, number of partitions.
TOPIC = "game-events"
SERVERS = "localhost:9092"
PARTITIONS = 2

ENVELOPE_SCHEMA = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("timestamp", T.TimestampType())]
)


def kafka_source_options(
    servers: str = SERVERS, topic: str = TOPIC, starting: str = "latest", max_offsets: int | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_event_source(
    spark: SparkSession, servers: str = SERVERS, topic: str = TOPIC, starting: str = "latest",
    max_offsets: int | None = None,
) -> DataFrame:
    """Stream of ``(value, timestamp)``; needs Spark's Kafka connector on the class path."""
    options = kafka_source_options(servers, topic, starting, max_offsets)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"), "timestamp")


def file_event_source(
    spark: SparkSession, folder: str, max_files: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The same stream from files: Parquet with both columns, or text with one message per line.

    A line of text arrives when its file was written.
    """
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "text":
        return reader.text(folder).select("value", F.col("_metadata.file_modification_time").alias("timestamp"))
    return reader.schema(ENVELOPE_SCHEMA).format(fmt).load(folder)


def event_partition(user_id: Column, num_partitions: int = PARTITIONS) -> Column:
    """All events of a user in one partition; cold users and faulty ids in the first."""
    user = user_id.try_cast("bigint")
    known = user.isNotNull() & (user != COLD_USER)
    return F.when(known, F.pmod(user, F.lit(num_partitions)).cast("int")).otherwise(F.lit(0))


def to_kafka_records(events: DataFrame, num_partitions: int = PARTITIONS) -> DataFrame:
    """``(key, value, partition)`` as a topic sink takes them, null fields kept."""
    fields = F.struct("user_id", "item_id", "rating", "timestamp")
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"),
        event_partition(F.col("user_id"), num_partitions).alias("partition"),
    )


def kafka_sink_options(servers: str = SERVERS, topic: str = TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_kafka_records(records: DataFrame, servers: str = SERVERS, topic: str = TOPIC) -> None:
    records.write.format("kafka").options(**kafka_sink_options(servers, topic)).save()
