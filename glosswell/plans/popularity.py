"""Most popular users: likes on their direct comments plus replies received."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.functions.scores import REPLY_CENTS, compounded_cents, like_cents, points
from glosswell.functions.text import ranking_lines
from glosswell.functions.times import hours, last_instant
from glosswell.operators.counts import start_rows, window_sum
from glosswell.operators.filters import direct_comments
from glosswell.operators.lookup import BUCKET_SECONDS
from glosswell.operators.ranking import top_k
from glosswell.operators.running import running_totals, time_slice
from glosswell.plans.threads import reply_credits

TOP_USERS = 10
WINDOW_HOURS = (24, 168, 720)


def likes(comments: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Like cents of each direct comment: ``create_date, user_id, cents``."""
    return direct_comments(comments).select(
        "create_date",
        "user_id",
        like_cents(F.col("recommendations"), F.col("editors_selection")).alias("cents"),
        *keep,
    )


def like_scores(comments: DataFrame, window_hours: int) -> DataFrame:
    """Like cents per user and window: ``window, user_id, cents``."""
    return window_sum(likes(comments), "create_date", hours(window_hours), "user_id", cents=F.sum("cents"))


def user_scores(scored: DataFrame, window_hours: int) -> DataFrame:
    """Total cents per user and window out of like and credit rows: ``window, user_id, cents``."""
    return window_sum(scored, "create_date", hours(window_hours), "user_id", cents=F.sum("cents"))


def rank_users(scores: DataFrame) -> DataFrame:
    """The ten best users: ``window_start, rank, user_id, cents``."""
    ranked = top_k(start_rows(scores), TOP_USERS, F.desc("cents"), F.asc("user_id"))
    return ranked.select("window_start", "rank", "user_id", "cents")


def popular_users(comments: DataFrame, window_hours: int, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Ranking per window, each user once: likes and replies of that window.

    Likes and credits are united before the one aggregation, so both combine on the map side.
    """
    credits = reply_credits(comments, bucket_seconds=bucket_seconds).select("create_date", "user_id", "cents")
    return rank_users(user_scores(likes(comments).unionByName(credits), window_hours))


def user_lines(ranked: DataFrame) -> DataFrame:
    return ranking_lines(ranked, F.col("user_id"), points(F.col("cents")))


def running_reply_scores(
    credits: DataFrame, bucket_seconds: int = BUCKET_SECONDS, stamp: str | None = None
) -> DataFrame:
    """Reply cents of each user after every credit: ``create_date, reply_id, hop, user_id, cents``.

    With ``stamp``, a time column of the credits, also its maximum so far, by the same name.
    """
    stamps = {f"latest_{stamp}": stamp} if stamp else {}
    counted = credits.select(
        "create_date", "reply_id", "hop", "user_id", F.lit(1).cast("bigint").alias("one"), *stamps.values()
    )
    totals = running_totals(
        counted,
        ["user_id"],
        ["create_date", "reply_id", "hop"],
        {"replies": "one"},
        time_slice(F.col("create_date"), bucket_seconds),
        stamps,
    )
    return totals.select(
        "create_date",
        "reply_id",
        "hop",
        "user_id",
        (F.col("replies") * REPLY_CENTS).alias("cents"),
        *[F.col(name).alias(source) for name, source in stamps.items()],
    )


def running_user_scores(
    credits: DataFrame,
    like_totals: DataFrame,
    bucket_seconds: int = BUCKET_SECONDS,
    stamp: str | None = None,
) -> DataFrame:
    """Running score after every credit and every window's like total; it never resets.

    The score adds up the running reply totals and the like totals seen so far. Both follow
    from two plain running totals per user (replies and like cents), see ``compounded_cents``.
    A like total stands at the last instant of its window, after any credit of that instant.
    Columns: ``at, is_like, reply_id, hop, user_id, cents`` (cents DECIMAL). With ``stamp``, a time
    column of both inputs, also its maximum so far, by the same name.
    """
    stamps = {f"latest_{stamp}": stamp} if stamp else {}
    credit_rows = credits.select(
        F.col("create_date").alias("at"),
        F.lit(0).alias("is_like"),
        "reply_id",
        "hop",
        "user_id",
        F.lit(1).cast("bigint").alias("one"),
        F.lit(0).cast("bigint").alias("like"),
        *stamps.values(),
    )
    like_rows = like_totals.select(
        last_instant(F.col("window")).alias("at"),
        F.lit(1).alias("is_like"),
        F.lit("").alias("reply_id"),
        F.lit(0).alias("hop"),
        "user_id",
        F.lit(0).cast("bigint").alias("one"),
        F.col("cents").alias("like"),
        *stamps.values(),
    )
    totals = running_totals(
        credit_rows.unionByName(like_rows),
        ["user_id"],
        ["at", "is_like", "reply_id", "hop"],
        {"replies": "one", "likes": "like"},
        time_slice(F.col("at"), bucket_seconds),
        stamps,
    )
    return totals.select(
        "at",
        "is_like",
        "reply_id",
        "hop",
        "user_id",
        compounded_cents(F.col("replies"), F.col("likes")).alias("cents"),
        *[F.col(name).alias(source) for name, source in stamps.items()],
    )


def rank_running(scores: DataFrame, window_hours: int) -> DataFrame:
    """The ten highest running scores seen in each window; a user may hold several places."""
    placed = scores.withColumn("window_start", F.window("at", hours(window_hours))["start"])
    ranked = top_k(
        placed,
        TOP_USERS,
        F.desc("cents"),
        *[F.asc(c) for c in ("at", "is_like", "reply_id", "hop", "user_id")],
    )
    return ranked.select("window_start", "rank", "user_id", "cents")


def popular_users_running(
    comments: DataFrame,
    window_hours: int,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Ranking by the ever-growing score: ``window_start, rank, user_id, cents``."""
    scores = running_user_scores(
        reply_credits(comments, bucket_seconds=bucket_seconds), like_scores(comments, window_hours), bucket_seconds
    )
    return rank_running(scores, window_hours)
