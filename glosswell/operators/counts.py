"""Tumbling-window counts and sums, the same on tables and on streams.

All are hash aggregations with a partial step before the shuffle, so a window or an article
that holds most rows still reaches the reducers as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_count(df: DataFrame, at: str, size: str, *keys: str, **extra: Column) -> DataFrame:
    """Rows per window and key: ``window, keys..., n, extra...``."""
    measures = [F.count(F.lit(1)).alias("n")] + [c.alias(name) for name, c in extra.items()]
    return df.groupBy(F.window(at, size).alias("window"), *keys).agg(*measures)


def window_sum(df: DataFrame, at: str, size: str, *keys: str, **sums: Column) -> DataFrame:
    """Aggregates per window and key: ``window, keys..., sums...``."""
    return df.groupBy(F.window(at, size).alias("window"), *keys).agg(
        *[c.alias(name) for name, c in sums.items()]
    )


def start_rows(counts: DataFrame) -> DataFrame:
    """Replace the window struct by its start."""
    rest = [c for c in counts.columns if c != "window"]
    return counts.select(F.col("window.start").alias("window_start"), *rest)
