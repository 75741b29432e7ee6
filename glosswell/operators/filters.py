"""Selections by thread depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.schema import DIRECT, REPLY


def direct_comments(comments: DataFrame) -> DataFrame:
    return comments.where(F.col("depth") == DIRECT)


def second_level(comments: DataFrame) -> DataFrame:
    return comments.where(F.col("depth") == REPLY)


def replies(comments: DataFrame) -> DataFrame:
    """Everything that is not a direct comment, odd depths included."""
    return comments.where(F.col("depth") != DIRECT)


def on_record(comments: DataFrame) -> DataFrame:
    """Comments whose author is kept on record: direct ones and replies to those."""
    return comments.where(F.col("depth").isin(DIRECT, REPLY))


def newest_approved(comments: DataFrame, k: int) -> DataFrame:
    """The k comments approved last, newest first: a top-k, never a full sort."""
    return (
        comments.select("comment_id", "approve_date")
        .orderBy(F.desc("approve_date"), F.asc("comment_id"))
        .limit(k)
    )
