"""Throughput meters over a table of stamped rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glosswell.operators.running import running_totals

# A one-minute exponentially weighted rate ticks every five seconds.
TICK_SECONDS = 5
RATE_SECONDS = 60
ALPHA = 1 - math.exp(-TICK_SECONDS / RATE_SECONDS)

# A block decays by e^-60. What lies 20 blocks back weighs e^-1200, which a double cannot tell from 0
# for any number of rows it can count; the carry is exact without older blocks.
BLOCK_TICKS = 720
CARRIED_BLOCKS = 20
DAY_TICKS = 17_280


def tick_of(stamp: str) -> Column:
    """Number of five-second ticks since the epoch."""
    return F.floor(F.unix_seconds(stamp) / F.lit(TICK_SECONDS))


def tick_start(tick: Column) -> Column:
    """When a tick begins."""
    return F.timestamp_seconds(tick * F.lit(TICK_SECONDS))


def counts_so_far(ticks: DataFrame) -> DataFrame:
    """Add ``cumulative``, the rows of a stage up to and including the tick."""
    return running_totals(
        ticks, ["stage"], ["tick"], {"cumulative": "n"}, F.floor(F.col("tick") / F.lit(DAY_TICKS))
    )


def one_minute_rates(ticks: DataFrame) -> DataFrame:
    """The one-minute rate in rows per second after each tick.

    Takes ``stage, tick, n, cumulative`` and adds ``rate``.

    The rate starts as the plain rate of the first tick and then moves by ALPHA towards the
    rate of each tick, which makes it a sum over all past ticks with falling weights. The time
    axis is cut into blocks: a tick adds up its own block so far and the decayed sums of the
    blocks before, so no task has to walk the whole series.
    """
    block = F.floor(F.col("tick") / F.lit(BLOCK_TICKS))
    weight = F.when(F.col("cumulative") == F.col("n"), F.lit(1.0)).otherwise(F.lit(ALPHA))
    age = (F.col("tick") - F.col("block") * F.lit(BLOCK_TICKS)) * F.lit(TICK_SECONDS / RATE_SECONDS)
    inside = Window.partitionBy("stage", "block").orderBy("tick").rowsBetween(Window.unboundedPreceding, 0)
    local = (
        ticks.withColumn("block", block)
        .withColumn("age", age)
        .withColumn("weighted", F.col("n") * weight * F.exp("age"))
        .withColumn("so_far", F.sum("weighted").over(inside))
    )
    # Sums of whole blocks as of their own start, by logarithm: their decay may lie out of range.
    before = Window.partitionBy("stage").orderBy("block").rangeBetween(-CARRIED_BLOCKS, -1)
    block_decay = BLOCK_TICKS * TICK_SECONDS / RATE_SECONDS
    carried = (
        local.groupBy("stage", "block")
        .agg(F.log(F.sum("weighted")).alias("mass"))
        .withColumn("earlier", F.collect_list(F.struct("block", "mass")).over(before))
        .select(
            "stage",
            "block",
            F.aggregate(
                "earlier",
                F.lit(0.0),
                lambda total, b: total + F.exp(b["mass"] - (F.col("block") - b["block"]) * F.lit(block_decay)),
            ).alias("carried"),
        )
    )
    return local.join(carried, ["stage", "block"]).select(
        "stage",
        "tick",
        "n",
        "cumulative",
        ((F.col("so_far") + F.col("carried")) * F.exp(-F.col("age")) / F.lit(float(TICK_SECONDS))).alias("rate"),
    )
