"""Raw comment lines as a DataFrame with one string column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files as they appear in a folder.

    Files are taken by modification time; write them in event order, or the watermark passes
    over the rows that come late.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def _kafka_options(servers: str, topic: str) -> dict[str, str]:
    # No group id of our own: readers that share one would each see a part of the topic.
    return {"kafka.bootstrap.servers": servers, "subscribe": topic}


def kafka_lines(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Everything a topic holds when it is read, one line per message; each scan asks anew."""
    return kafka_values(spark.read.format("kafka").options(**_kafka_options(servers, topic)).load())


def stream_kafka_lines(
    spark: SparkSession, servers: str, topic: str, max_per_trigger: int | None = None
) -> DataFrame:
    """A topic as a stream of lines, one per message."""
    reader = spark.readStream.format("kafka").options(**_kafka_options(servers, topic))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return kafka_values(reader.load())


def kafka_values(messages: DataFrame) -> DataFrame:
    """Message bytes as UTF-8 text."""
    return messages.select(F.col("value").cast("string").alias("value"))
