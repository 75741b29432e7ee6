"""Popular users on a stream: per window, and by the running score."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from glosswell.functions.scores import REPLY_CENTS
from glosswell.functions.times import hours, last_instant
from glosswell.operators.counts import window_sum
from glosswell.plans.popularity import TOP_USERS, like_scores, likes, user_scores
from glosswell.plans.reports import STAMP, like_scores_stamped
from glosswell.streaming.state import SecondQueue

WAITING_TYPE = "at_us bigint, is_like int, reply_id string, hop int, cents bigint, stamp_us bigint"
SCORED_TYPE = "at_us bigint, is_like int, reply_id string, hop int, user_id string, cents decimal(38,0)"
STAMPED_TYPE = f"{SCORED_TYPE}, stamp_us bigint"
SALTS = 64


def window_stamps(comments: DataFrame, credits: DataFrame, window_hours: int) -> DataFrame:
    """Latest ingest time behind a user's score in each closed window: ``window, user_id, ingest_ts``.

    Likes and credits feed the same window, which closes by the smaller of both watermarks; one with
    credits only has a row as well.
    """
    rows = likes(comments, keep=(STAMP,)).drop("cents").unionByName(credits.select("create_date", "user_id", STAMP))
    return window_sum(rows, "create_date", hours(window_hours), "user_id", **{STAMP: F.max(STAMP)})


def window_scores(comments: DataFrame, credits: DataFrame, window_hours: int) -> DataFrame:
    """Closed windows of cents per user: ``window, user_id, cents``.

    Both streams are watermarked by the caller; rank the batches with ``plans.rank_users``.
    """
    scored = likes(comments).unionByName(credits.select("create_date", "user_id", "cents"))
    return user_scores(scored, window_hours)


class RunningScore(StatefulProcessor):
    """Replies and like cents of a user so far, and the latest stamp behind them; one row out per row in.

    Rows wait until the watermark has passed them and are then taken in event order: a window's
    like total comes out of its aggregation later than replies made after the window. A row
    that is itself behind the watermark is not lost, it is taken at once.

    ``compounded`` adds up the running reply totals; without it the score is that of the replies and
    likes themselves. ``keep_seconds`` is after how long without a row a user starts anew; None is never.
    """

    def __init__(self, compounded: bool = True, keep_seconds: int | None = None):
        self.compounded, self.keep_seconds = compounded, keep_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "replies bigint, score decimal(38,0), stamp_us bigint, last_ms bigint")
        self.waiting = SecondQueue(handle, "waiting", WAITING_TYPE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        added = [(r.at_us, r.is_like, r.reply_id, r.hop, r.cents, r.stamp_us) for r in rows]
        self.waiting.add(added)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        expiry = expiredTimerInfo.getExpiryTimeInMs()
        ready = sorted(self.waiting.release(expiry), key=lambda r: r[:4])
        if ready:
            replies, score, latest, _ = self.totals.get() if self.totals.exists() else (0, Decimal(0), None, 0)
            for at_us, is_like, reply_id, hop, cents, stamp_us in ready:
                if is_like:
                    score += cents
                else:
                    replies += 1
                    score += REPLY_CENTS * (replies if self.compounded else 1)
                if stamp_us is not None:
                    latest = stamp_us if latest is None else max(latest, stamp_us)
                yield Row(
                    at_us=at_us, is_like=is_like, reply_id=reply_id, hop=hop, user_id=key[0], cents=score, stamp_us=latest
                )
            self.totals.update((replies, score, latest, expiry))
            if self.keep_seconds is not None:
                self.handle.registerTimer(expiry + self.keep_seconds * 1_000)
        elif self.keep_seconds is not None and self.totals.exists():
            if self.totals.get()[3] + self.keep_seconds * 1_000 <= expiry:
                self.totals.clear()

    def close(self) -> None:
        pass


def _scored(rows: DataFrame, processor: RunningScore, stamped: bool) -> DataFrame:
    scored = rows.groupBy("user_id").transformWithState(
        statefulProcessor=processor, outputStructType=STAMPED_TYPE, outputMode="Append", timeMode="EventTime"
    )
    stamps = [F.timestamp_micros("stamp_us").alias(STAMP)] if stamped else []
    return scored.select(
        F.timestamp_micros("at_us").alias("at"), "is_like", "reply_id", "hop", "user_id", "cents", *stamps
    )


def _credit_rows(credits: DataFrame, stamped: bool) -> DataFrame:
    return credits.select(
        F.unix_micros("create_date").alias("at_us"),
        F.lit(0).alias("is_like"),
        "reply_id",
        "hop",
        "user_id",
        "cents",
        (F.unix_micros(STAMP) if stamped else F.lit(None).cast("bigint")).alias("stamp_us"),
    )


def running_reply_scores(credits: DataFrame, stamped: bool = False, keep_seconds: int | None = None) -> DataFrame:
    """Reply cents of each user after every credit: ``create_date, reply_id, hop, user_id, cents``.

    ``credits`` is watermarked by the caller. ``stamped`` adds the latest ``ingest_ts`` so far.
    """
    scored = _scored(_credit_rows(credits, stamped), RunningScore(False, keep_seconds), stamped)
    stamps = [STAMP] if stamped else []
    return scored.select(F.col("at").alias("create_date"), "reply_id", "hop", "user_id", F.col("cents").cast("bigint").alias("cents"), *stamps)


def running_scores(
    comments: DataFrame, credits: DataFrame, window_hours: int, stamped: bool = False, keep_seconds: int | None = None
) -> DataFrame:
    """Running score after each credit and each closed window's like total.

    Both streams are watermarked by the caller. The time goes into the state as a number, not as
    the watermarked column, so late credits still count; only the windowed like totals drop
    late rows. ``stamped`` adds the latest ``ingest_ts`` of what is behind the score so far: it is
    carried through both watermarks together with the score.
    """
    totals = like_scores_stamped(comments, window_hours) if stamped else like_scores(comments, window_hours)
    like_rows = totals.select(
        F.unix_micros(last_instant(F.col("window"))).alias("at_us"),
        F.lit(1).alias("is_like"),
        F.lit("").alias("reply_id"),
        F.lit(0).alias("hop"),
        "user_id",
        "cents",
        (F.unix_micros(STAMP) if stamped else F.lit(None).cast("bigint")).alias("stamp_us"),
    )
    return _scored(_credit_rows(credits, stamped).unionByName(like_rows), RunningScore(True, keep_seconds), stamped)


class TopRows(StatefulProcessor):
    """The best rows of one share of a window, given out when the watermark passes its end.

    A row is late only when its window has closed.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", f"rows array<struct<{_struct_fields()}>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[1] <= timerValues.getCurrentWatermarkInMs():
            return iter(())
        best = [tuple(r) for r in self.best.get()[0]] if self.best.exists() else []
        for row in rows:
            best.append((row.at_us, row.is_like, row.reply_id, row.hop, row.user_id, row.cents))
            if len(best) > 20 * TOP_USERS:
                best = _best(best)
        self.best.update((_best(best),))
        self.handle.registerTimer(key[1])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        for at_us, is_like, reply_id, hop, user_id, cents in self.best.get()[0]:
            yield Row(
                at_us=at_us, is_like=is_like, reply_id=reply_id, hop=hop, user_id=user_id, cents=cents
            )
        self.best.clear()

    def close(self) -> None:
        pass


def _struct_fields() -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (f.split(" ") for f in SCORED_TYPE.split(", ")))


def _best(rows: list[tuple]) -> list[tuple]:
    """The first rows by falling score, then time, kind, reply, hop and user."""
    return sorted(rows, key=lambda r: (-r[5], *r[:5]))[:TOP_USERS]


def top_running(scores: DataFrame, window_hours: int, salts: int = SALTS) -> DataFrame:
    """Best running scores of each closed window, up to ten per salt.

    ``scores`` is watermarked on ``at``. A window's rows are spread over salts, so even one
    month-long window keeps many tasks busy; what is left for the final ranking of a batch
    (``plans.rank_running``) is at most ten rows per salt and window. ``salts`` is how many tasks
    can work on one window.
    """
    size_us = window_hours * 3_600_000_000
    at_us = F.unix_micros("at")
    spread = scores.select(
        at_us.alias("at_us"),
        "is_like",
        "reply_id",
        "hop",
        "user_id",
        "cents",
        F.floor((at_us - F.pmod(at_us, F.lit(size_us)) + F.lit(size_us)) / F.lit(1_000)).alias("end_ms"),
        F.pmod(F.xxhash64("user_id", at_us, "reply_id", "hop"), F.lit(salts)).alias("salt"),
    )
    best = spread.groupBy("salt", "end_ms").transformWithState(
        statefulProcessor=TopRows(), outputStructType=SCORED_TYPE, outputMode="Append", timeMode="EventTime"
    )
    return best.select(
        F.timestamp_micros("at_us").alias("at"), "is_like", "reply_id", "hop", "user_id", "cents"
    )
