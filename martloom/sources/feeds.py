"""Change feeds: streams with the columns key, value, topic, timestamp and, where the feed has one, offset."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

FEED_SCHEMA = "key string, value string, topic string, timestamp timestamp"


def kafka_feed(
    spark: SparkSession,
    servers: str,
    topics: Iterable[str],
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> DataFrame:
    """Needs the Kafka connector jar on the cluster. Topic names are the caller's.

    A first run starts with the oldest record, so the initial snapshot is read; later runs go on from their
    progress folder. Records that expired unread stop the stream unless fail_on_data_loss is False.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def file_feed(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """The same feed from a folder of JSON lines, e.g. a topic archive."""
    return (
        spark.readStream.schema(FEED_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).json(path)
    )
