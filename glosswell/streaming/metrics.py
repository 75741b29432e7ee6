"""Reports on live streams: ingest stamps, window latency, input throughput and rates."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from glosswell.operators.meters import ALPHA, TICK_SECONDS
from glosswell.plans.reports import STAMP, input_ticks, stage_counts
from glosswell.schema import DIRECT
from glosswell.sinks.files import each_batch


def stamp(rows: DataFrame) -> DataFrame:
    """Add the time the rows came in, one time per micro-batch."""
    return rows.withColumn(STAMP, F.current_timestamp())


def emission_latency(closed: DataFrame) -> DataFrame:
    """For a batch of closed windows, milliseconds from latest ingest to now.

    ``closed`` has ``window`` and ``ingest_ts``: use it as the report of ``sinks.each_batch``.
    """
    return (
        closed.groupBy("window")
        .agg(F.max(STAMP).alias(STAMP))
        .select(
            F.col("window.start").alias("window_start"),
            (F.unix_millis(F.current_timestamp()) - F.unix_millis(STAMP)).alias("latency_ms"),
        )
    )


def count_input(comments: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Keep how many comments each query took in, per tick, as a table with one folder per micro-batch.

    A repeated batch replaces its counts, so totals stay right when the stream starts again.
    """
    return each_batch(comments, input_ticks, folder, checkpoint)


def read_input(spark: SparkSession, folder: str) -> DataFrame:
    """What ``count_input`` has counted so far: ``stage, tick, n``."""
    counts = spark.read.schema("stage string, tick bigint, n bigint, batch bigint").option("basePath", folder).parquet(folder)
    return counts.groupBy("stage", "tick").agg(F.sum("n").alias("n"))


class MinuteRate(StatefulProcessor):
    """The one-minute rate of a stage after each of its closed ticks: a decayed sum, one value per stage.

    Ticks of a stage come in order from batch to batch.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "tick bigint, cumulative bigint, rate double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, cumulative, rate = self.held.get() if self.held.exists() else (None, 0, 0.0)
        for tick, n in sorted((r.tick, r.n) for r in rows):
            cumulative += n
            # Ticks without rows have let the rate fall; the first tick sets it.
            fallen = 0.0 if last is None else rate * (1 - ALPHA) ** (tick - last)
            rate = n / TICK_SECONDS if last is None else fallen + ALPHA * n / TICK_SECONDS
            last = tick
            yield Row(stage=key[0], tick=tick, n=n, cumulative=cumulative, rate=rate)
        if last is not None:
            self.held.update((last, cumulative, rate))

    def close(self) -> None:
        pass


def minute_rates(comments: DataFrame) -> DataFrame:
    """``stage, tick, n, cumulative, rate`` of each closed tick of input, in append mode.

    ``comments`` is watermarked on ``ingest_ts``; what comes behind the watermark is not counted.
    """
    ticks = comments.groupBy(F.window(STAMP, f"{TICK_SECONDS} seconds").alias("window")).agg(
        F.count(F.lit(1)).alias("every"), F.count_if(F.col("depth") == DIRECT).alias("direct")
    )
    tick = F.floor(F.unix_seconds("window.start") / F.lit(TICK_SECONDS)).alias("tick")
    rows = ticks.select(tick, F.inline(stage_counts())).where(F.col("n") > 0)
    return rows.groupBy("stage").transformWithState(
        statefulProcessor=MinuteRate(),
        outputStructType="stage string, tick bigint, n bigint, cumulative bigint, rate double",
        outputMode="Append",
        timeMode="EventTime",
    )
