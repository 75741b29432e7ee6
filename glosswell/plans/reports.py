"""Operational reports: throughput of the inputs and stages, latency of the windows.

They read comments that carry ``ingest_ts``, the time a comment entered the job, and are plain
table jobs; ``streaming.metrics`` stamps live streams with the same column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glosswell.functions.times import SLOT_MINUTES, days, hour_of_day, hours
from glosswell.operators.counts import start_rows, window_count, window_sum
from glosswell.operators.filters import direct_comments
from glosswell.operators.lookup import BUCKET_SECONDS
from glosswell.operators.later import least_later
from glosswell.operators.meters import TICK_SECONDS, counts_so_far, one_minute_rates, tick_of
from glosswell.plans.popularity import likes
from glosswell.plans.threads import reply_credits
from glosswell.schema import DIRECT

STAMP = "ingest_ts"


def article_counts_stamped(comments: DataFrame, window_hours: int) -> DataFrame:
    """Article counts with the latest ingest time: ``window, article_id, n, ingest_ts``."""
    return window_count(
        comments, "create_date", hours(window_hours), "article_id", **{STAMP: F.max(STAMP)}
    )


def article_direct_counts_stamped(comments: DataFrame) -> DataFrame:
    """Direct comments per article and two hours with the earliest ingest time."""
    return window_count(
        direct_comments(comments),
        "create_date",
        f"{SLOT_MINUTES} minutes",
        "article_id",
        **{STAMP: F.min(STAMP)},
    )


def direct_counts_stamped(comments: DataFrame) -> DataFrame:
    """Direct comments per two hours with the latest article stamp: ``window, hour, n, ingest_ts``."""
    per_article = article_direct_counts_stamped(comments)
    return (
        per_article.groupBy("window")
        .agg(F.sum("n").alias("n"), F.max(STAMP).alias(STAMP))
        .select("window", hour_of_day(F.col("window.start")).alias("hour"), "n", STAMP)
    )


def slot_totals_stamped(comments: DataFrame, window_days: int) -> DataFrame:
    """Slot totals with the latest stamp: ``window, hour, n, ingest_ts``."""
    per_slot = direct_counts_stamped(comments).select(
        F.window_time("window").alias("at"), "hour", "n", STAMP
    )
    return window_sum(
        per_slot, "at", days(window_days), "hour", n=F.sum("n"), **{STAMP: F.max(STAMP)}
    )


def like_scores_stamped(comments: DataFrame, window_hours: int) -> DataFrame:
    """Like cents with the latest ingest time: ``window, user_id, cents, ingest_ts``."""
    return window_sum(
        likes(comments, keep=(STAMP,)),
        "create_date",
        hours(window_hours),
        "user_id",
        cents=F.sum("cents"),
        **{STAMP: F.max(STAMP)},
    )


def user_stamps(comments: DataFrame, window_hours: int, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Latest ingest time behind a user's score, never falling: ``window, user_id, ingest_ts``.

    Reduced to one row per user and window before the running maximum, so a user's rows are as
    many as the windows they appear in.
    """
    scored = likes(comments, keep=(STAMP,)).drop("cents")
    credits = reply_credits(comments, keep=(STAMP,), bucket_seconds=bucket_seconds)
    rows = scored.unionByName(credits.select("create_date", "user_id", STAMP))
    newest = window_sum(rows, "create_date", hours(window_hours), "user_id", **{STAMP: F.max(STAMP)})
    so_far = (
        Window.partitionBy("user_id")
        .orderBy("window")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return newest.withColumn(STAMP, F.max(STAMP).over(so_far))


# Throughput


def stage_counts() -> Column:
    """Counts ``every`` and ``direct`` of comments as what each query takes in: an array of ``stage, n``."""
    stages = {"query1_in": "every", "query2_in": "direct", "query3_in": "every"}
    return F.array(*[F.struct(F.lit(s).alias("stage"), F.col(c).alias("n")) for s, c in stages.items()])


def input_ticks(comments: DataFrame) -> DataFrame:
    """Comments each query takes in per tick: ``stage, tick, n``.

    Counted once per tick and then told apart by query, so comments are not multiplied.
    """
    counts = comments.groupBy(tick_of(STAMP).alias("tick")).agg(
        F.count(F.lit(1)).alias("every"), F.count_if(F.col("depth") == DIRECT).alias("direct")
    )
    return counts.select("tick", F.inline(stage_counts())).where(F.col("n") > 0).select("stage", "tick", "n")


def stage_ticks(
    comments: DataFrame,
    article_hours: int = 24,
    slot_days: int = 7,
    user_hours: int = 24,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Records that enter each window stage per tick: ``stage, tick, n``.

    Every part is counted per tick before the parts are put together; rows that enter two stages
    are made once and name both.
    """
    parts = {
        ("query1_window",): article_counts_stamped(comments, article_hours),
        ("query2_inner_window",): article_direct_counts_stamped(comments),
        ("query2_final_window",): slot_totals_stamped(comments, slot_days),
        ("query3_likes", "query3_window"): like_scores_stamped(comments, user_hours),
        ("query3_window",): reply_credits(comments, keep=(STAMP,), bucket_seconds=bucket_seconds),
    }
    counted = [
        rows.groupBy(tick_of(STAMP).alias("tick"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.explode(F.array(*map(F.lit, stages))).alias("stage"), "tick", "n")
        for stages, rows in parts.items()
    ]
    return reduce(DataFrame.unionByName, counted).groupBy("stage", "tick").agg(F.sum("n").alias("n"))


def throughput(ticks: DataFrame) -> DataFrame:
    """Records per five-second tick and so far: ``stage, tick, n, cumulative``."""
    return counts_so_far(ticks)


def throughput_rates(ticks: DataFrame) -> DataFrame:
    """One-minute rate per tick: ``stage, tick, n, cumulative, rate``."""
    return one_minute_rates(counts_so_far(ticks))


# Latency


def _window_start(at: Column, size: str) -> Column:
    return F.window(at, size)["start"]


def closings(comments: DataFrame, size: str, delay_seconds: int) -> DataFrame:
    """What moves the watermark: the earliest ingest per window the watermark then lies in.

    The watermark trails the newest comment by ``delay_seconds``: ``window_start, seen``.
    """
    reached = F.timestamp_micros(F.unix_micros("create_date") - F.lit(delay_seconds * 1_000_000))
    return (
        comments.select(reached.alias("reached"), STAMP)
        .groupBy(_window_start(F.col("reached"), size).alias("window_start"))
        .agg(F.min(STAMP).alias("seen"))
    )


def latencies(latest: DataFrame, closing: DataFrame, size_seconds: int) -> DataFrame:
    """Milliseconds from a window's latest ingest to its emission: ``window_start, latency_ms``.

    A window is emitted when the first comment comes in that puts the watermark in a later
    window; windows nothing has closed are left out. ``size_seconds`` is the windows' length.
    """
    both = latest.select("window_start", F.col(STAMP).alias("latest"), F.lit(None).cast("timestamp").alias("seen"))
    both = both.unionByName(
        closing.select("window_start", F.lit(None).cast("timestamp").alias("latest"), "seen")
    )
    windows = both.groupBy("window_start").agg(F.max("latest").alias("latest"), F.min("seen").alias("seen"))
    number = F.floor(F.unix_seconds("window_start") / F.lit(size_seconds))
    return (
        least_later(windows.withColumn("number", number), "number", "seen", "emitted")
        .where(F.col("latest").isNotNull() & F.col("emitted").isNotNull())
        .select(
            "window_start",
            (F.unix_millis("emitted") - F.unix_millis("latest")).alias("latency_ms"),
        )
    )


def _latest_per_window(rows: DataFrame) -> DataFrame:
    return start_rows(rows.groupBy("window").agg(F.max(STAMP).alias(STAMP)))


def article_latency(comments: DataFrame, window_hours: int, delay_seconds: int = 1) -> DataFrame:
    size = hours(window_hours)
    latest = _latest_per_window(article_counts_stamped(comments, window_hours))
    return latencies(latest, closings(comments, size, delay_seconds), window_hours * 3_600)


def slot_latency(comments: DataFrame, window_days: int, delay_seconds: int = 0) -> DataFrame:
    latest = _latest_per_window(slot_totals_stamped(comments, window_days))
    return latencies(latest, closings(direct_comments(comments), days(window_days), delay_seconds), window_days * 86_400)


def user_latency(
    comments: DataFrame, window_hours: int, delay_seconds: int = 1, bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    latest = _latest_per_window(user_stamps(comments, window_hours, bucket_seconds))
    return latencies(latest, closings(comments, hours(window_hours), delay_seconds), window_hours * 3_600)


def latency_lines(rows: DataFrame) -> DataFrame:
    """``start_ms,latency_ms`` per window."""
    line = F.concat_ws(",", F.unix_millis("window_start").cast("string"), F.col("latency_ms").cast("string"))
    return rows.select("window_start", line.alias("line"))


def throughput_lines(ticks: DataFrame) -> DataFrame:
    """``stage , tick_ms , count so far , rate`` per tick."""
    rated = throughput_rates(ticks)
    millis = (F.col("tick") * F.lit(TICK_SECONDS * 1_000)).cast("string")
    line = F.concat_ws(" , ", "stage", millis, F.col("cumulative").cast("string"), F.col("rate").cast("string"))
    return rated.select("stage", "tick", line.alias("line"))
