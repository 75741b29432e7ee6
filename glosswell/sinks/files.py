"""File sinks for tables and streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def write_lines(lines: DataFrame, path: str) -> None:
    """One text file of result lines in window order, replacing what was there.

    Only for rankings and other reports of one short line per window. The shuffle to a single
    partition comes after the report is made, so making it stays parallel.
    """
    lines.repartition(1).sortWithinPartitions("window_start").select("line").write.mode("overwrite").text(path)


def write_table(rows: DataFrame, path: str, *partition_by: str) -> None:
    """A parquet table, replacing what was there."""
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """The rows of one micro-batch in their own folder; a repeated batch replaces itself."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def write_batch_lines(lines: DataFrame, batch_id: int, path: str) -> None:
    """The lines of one micro-batch as one text file, in window order; a repeated batch replaces its file."""
    write_lines(lines, f"{path}/batch={batch_id}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """What is directly under a folder, by full path; nothing if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [x.getPath().toString() for x in files.listStatus(folder)] if files.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller has made for itself."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def claim(batch: DataFrame, path: str) -> None:
    """Mark a folder of batches as this stream's; refuse one that another stream has marked.

    A stream with a new checkpoint is another one: its batches count from 0 again and would replace
    and mix with those that are there.
    """
    spark = batch.sparkSession
    own = f"_stream-{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"
    names = [x.rsplit("/", 1)[1] for x in folders(spark, path)]
    if any(n.startswith("_stream-") and n != own for n in names):
        raise ValueError(f"{path} holds the output of another stream; give the new one a new folder")
    if own not in names:
        mark = spark._jvm.org.apache.hadoop.fs.Path(path, own)
        mark.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(mark)


def append_table(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A stream appended to a parquet table, each row once."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def each_batch(
    rows: DataFrame,
    report: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    write: Callable[[DataFrame, int, str], None] = write_batch,
) -> DataStreamWriter:
    """Apply a table report to every micro-batch of finished rows and keep the result.

    ``rows`` is an append-mode stream of closed windows: all rows of a window come in one
    batch, so ranking inside the batch ranks the whole window. ``write`` takes the report, the batch and
    ``path``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        claim(batch, path)
        write(report(batch), batch_id, path)

    return rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(handle)


def each_batch_parts(
    rows: DataFrame, parts: dict[str, Callable[[DataFrame], DataFrame]], checkpoint: str
) -> DataStreamWriter:
    """Every micro-batch, computed once, into several tables by path."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for path, part in parts.items():
                claim(batch, path)
                write_batch(part(batch), batch_id, path)
        finally:
            batch.unpersist()

    return rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(handle)


def to_console(rows: DataFrame, checkpoint: str, lines: int = 2**31 - 1) -> DataStreamWriter:
    """Print every row; ``lines`` shows fewer of each micro-batch."""
    return (
        rows.writeStream.format("console")
        .outputMode("append")
        .option("numRows", lines)
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
    )


def print_lines(lines: DataFrame) -> None:
    """Result lines on the console, one line per window."""
    for row in lines.orderBy("window_start").toLocalIterator():
        print(row.line)
