"""Direct comments by two-hour slot of the day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.functions.text import row_lines
from glosswell.functions.times import SLOT_MINUTES, days, hour_of_day
from glosswell.operators.counts import start_rows, window_count, window_sum
from glosswell.operators.filters import direct_comments
from glosswell.operators.slots import SLOT_COLUMNS, spread_slots

WINDOW_DAYS = (1, 7, 30)


def article_direct_counts(comments: DataFrame) -> DataFrame:
    """Direct comments per article and two hours: ``window, article_id, n``."""
    return window_count(direct_comments(comments), "create_date", f"{SLOT_MINUTES} minutes", "article_id")


def direct_counts(comments: DataFrame) -> DataFrame:
    """Direct comments per two hours with the hour of day: ``window, hour, n``.

    Counted straight from the comments. Partial aggregation already sends one row per map task
    and window, which is what a per-article stage in between would be for.
    """
    counts = window_count(direct_comments(comments), "create_date", f"{SLOT_MINUTES} minutes")
    return counts.select("window", hour_of_day(F.col("window.start")).alias("hour"), "n")


def slot_totals(comments: DataFrame, window_days: int) -> DataFrame:
    """Direct comments per slot of the day and window: ``window, hour, n``.

    The two-hour windows nest in the larger ones, so they are chained by their window time.
    """
    per_slot = direct_counts(comments).select(F.window_time("window").alias("at"), "hour", "n")
    return window_sum(per_slot, "at", days(window_days), "hour", n=F.sum("n"))


def slot_counts(comments: DataFrame, window_days: int) -> DataFrame:
    """One row per window with the twelve slots as columns."""
    return start_rows(spread_slots(slot_totals(comments, window_days)))


def slot_lines(comments: DataFrame, window_days: int) -> DataFrame:
    return row_lines(slot_counts(comments, window_days), SLOT_COLUMNS)
