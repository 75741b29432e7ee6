"""Kafka sinks. The Kafka connector package has to be on the cluster's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def messages(rows: DataFrame) -> DataFrame:
    """Every row as one JSON message."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def line_messages(lines: DataFrame) -> DataFrame:
    """Every result line as one message."""
    return lines.select(F.col("line").alias("value"))


def batch_messages(lines: DataFrame, batch_id: int) -> DataFrame:
    """Result lines of one micro-batch, each with what tells a repeated one apart: the window is the key
    and, with the batch, a header. A batch that is sent again brings the same keys and headers."""
    window = F.unix_millis("window_start").cast("string")
    header = lambda name, value: F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))
    return lines.select(
        window.alias("key"),
        F.col("line").alias("value"),
        F.array(header("batch", F.lit(str(batch_id))), header("window", window)).alias("headers"),
    )


def send(messages: DataFrame, servers: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def send_stream(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (
        messages.writeStream.format("kafka")
        .outputMode("append")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
