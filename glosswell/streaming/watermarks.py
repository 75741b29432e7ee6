"""Event time of comment streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOUND_SECONDS = 1


def bounded(comments: DataFrame, at: str = "create_date", seconds: int = BOUND_SECONDS) -> DataFrame:
    """Comments may be late by ``seconds``; a window closes when the watermark passes its end.

    Spark moves the watermark between micro-batches, so a late row of the same batch still counts.
    """
    return comments.withWatermark(at, f"{seconds} seconds")


def ascending(comments: DataFrame, at: str = "create_date") -> DataFrame:
    """Comments come in order."""
    return bounded(comments, at, 0)


def behind(condition: Column) -> Column:
    """A filter condition that stays behind the watermark, so that rows it leaves out move it too.

    Spark evaluates deterministic filters before the watermark; this one only looks as if it weren't.
    """
    return condition | (F.rand() < F.rand() * 0)
