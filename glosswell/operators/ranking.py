"""Best k rows per window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(rows: DataFrame, k: int, *order: Column, by: str = "window_start") -> DataFrame:
    """The first k rows of every window in ``order``, with their rank.

    The filter on the row number lets Spark put a group limit ahead of the shuffle: each map
    task sends at most k rows per window, however few windows there are.
    """
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return rows.withColumn("rank", place).where(F.col("rank") <= k)
