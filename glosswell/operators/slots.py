"""Time-of-day slots as columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOT_HOURS = tuple(range(0, 24, 2))
SLOT_COLUMNS = [f"h{hour:02d}" for hour in SLOT_HOURS]


def spread_slots(totals: DataFrame) -> DataFrame:
    """Turn ``window, hour, n`` rows into twelve columns per window, missing slots as 0.

    Conditional sums instead of a pivot: they aggregate partially, and a stream accepts them
    in append mode.
    """
    columns = [
        F.sum(F.when(F.col("hour") == hour, F.col("n")).otherwise(F.lit(0))).alias(name)
        for hour, name in zip(SLOT_HOURS, SLOT_COLUMNS)
    ]
    return totals.groupBy("window").agg(*columns)
