"""Reply credits on a stream, equal to those of the table plan whatever a micro-batch holds.

The author record is keyed state: the entries of a comment id, each with its time, live in the
partition of the id, and a reply is sent there to be answered. A reply waits until the watermark
has passed it; then the newest entry not younger than the reply answers, in whatever order both came
in. Two hops make two steps with a table between them: entries with their parent's author, then
credits. Entries leave the first step in the order of the watermark, so the second step's own
watermark over that table says up to when it is complete.

No row is dropped for being late: a late entry answers what is asked after it, a late reply is answered
with the next watermark. Time goes into the state as a number, so that nothing is filtered by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from glosswell.functions.scores import REPLY_CENTS
from glosswell.schema import DIRECT, REPLY
from glosswell.streaming.state import SecondQueue, TimedRecord
from glosswell.streaming.watermarks import behind

ENTRIES_TYPE = "comment_id string, create_date timestamp, user_id string, parent_user_id string"
CREDITS_TYPE = (
    "reply_id string, hop int, user_id string, cents bigint, create_date timestamp, ingest_ts timestamp"
)
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# What a row does at its key: it is an entry, it asks for one, or it only waits its turn.
OFFERS, ASKS, WAITS = 0, 1, 2


def _instant(micros: int | None) -> datetime | None:
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


class _Answers(StatefulProcessor):
    """Keeps the entries of a key by time and answers the rows that ask once the watermark passes them.

    ``keep_seconds`` is how long an entry stays on record; None is for good.
    """

    def __init__(self, keep_seconds: int | None = None):
        self.keep_seconds = keep_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = TimedRecord(
            handle, "entries", "at_us bigint, user_id string, parent_user_id string", self.keep_seconds
        )
        self.waiting = SecondQueue(
            handle, "waiting", "at_us bigint, role int, comment_id string, user_id string, stamp_us bigint"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        offered, asked = [], []
        for r in rows:
            if r.role == OFFERS:
                offered.append((r.at_us, r.user_id, r.parent_user_id))
            else:
                asked.append((r.at_us, r.role, r.comment_id, r.user_id, r.stamp_us))
        if offered:
            self.entries.add(offered)
        if asked:
            self.waiting.add(asked)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        expiry = expiredTimerInfo.getExpiryTimeInMs()
        ready = sorted(self.waiting.release(expiry), key=lambda r: (r[0], r[2] or ""))
        if ready:
            for row, entry in zip(ready, self.entries.as_of([r[0] for r in ready])):
                yield from self.answer(row, entry)
        self.entries.expire(expiry)

    def answer(self, row: tuple, entry: tuple | None) -> Iterator[Row]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class ParentAnswers(_Answers):
    """Entry of a comment, with its parent's author where it answers one on record."""

    def answer(self, row: tuple, entry: tuple | None) -> Iterator[Row]:
        at_us, role, comment_id, user_id, _ = row
        parent = entry[1] if entry and role == ASKS else None
        yield Row(comment_id=comment_id, create_date=_instant(at_us), user_id=user_id, parent_user_id=parent)


class CreditAnswers(_Answers):
    """Credits of a reply: the author answered and, one level up, the parent's author."""

    def answer(self, row: tuple, entry: tuple | None) -> Iterator[Row]:
        at_us, _, comment_id, _, stamp_us = row
        for hop, user in enumerate(entry[1:] if entry else (), start=1):
            if user is not None:
                yield Row(
                    reply_id=comment_id,
                    hop=hop,
                    user_id=user,
                    cents=REPLY_CENTS,
                    create_date=_instant(at_us),
                    ingest_ts=_instant(stamp_us),
                )


def _role(key: Column, role: int, parent: Column | None = None, stamp: Column | None = None) -> Column:
    none = F.lit(None)
    return F.struct(
        key.alias("key"),
        F.lit(role).alias("role"),
        F.col("comment_id").alias("comment_id"),
        F.unix_micros("create_date").alias("at_us"),
        F.col("user_id").alias("user_id"),
        (none.cast("string") if parent is None else parent).alias("parent_user_id"),
        (none.cast("bigint") if stamp is None else F.unix_micros(stamp)).alias("stamp_us"),
    )


def _keyed(rows: DataFrame, processor: StatefulProcessor, output: str) -> DataFrame:
    return rows.groupBy("key").transformWithState(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime"
    )


def author_entries(comments: DataFrame, keep_seconds: int | None = None) -> DataFrame:
    """Stream of author entries: ``comment_id, create_date, user_id, parent_user_id``.

    ``comments`` is watermarked. Every entry comes once the watermark has passed it. With
    ``keep_seconds`` a comment's author is forgotten so long after the hour it was made in.
    """
    offers = _role(F.col("comment_id"), OFFERS)
    first = _role(F.col("comment_id"), WAITS)
    second = _role(F.col("in_reply_to"), ASKS)
    roles = comments.where(behind(F.col("depth").isin(DIRECT, REPLY))).select(
        F.inline(F.array(offers, F.when(F.col("depth") == REPLY, second).otherwise(first)))
    )
    return _keyed(roles, ParentAnswers(keep_seconds), ENTRIES_TYPE).dropna(subset=["comment_id", "user_id"])


def reply_credits(comments: DataFrame, entries: DataFrame, keep_seconds: int | None = None) -> DataFrame:
    """Stream of credits: ``reply_id, hop, user_id, cents, create_date, ingest_ts``.

    ``comments`` and ``entries``, the table that ``author_entries`` is written to read as a stream,
    are both watermarked. Each micro-batch has to take all entries there are: files of one batch of
    entries are not in order among themselves. ``ingest_ts`` is the reply's, null where it has none.
    ``keep_seconds`` as for ``author_entries``.
    """
    offers = entries.select(
        F.inline(F.array(_role(F.col("comment_id"), OFFERS, parent=F.col("parent_user_id"))))
    )
    stamp = F.col("ingest_ts") if "ingest_ts" in comments.columns else None
    asks = comments.where(behind(F.col("depth") != DIRECT)).select(F.inline(F.array(_role(F.col("in_reply_to"), ASKS, stamp=stamp))))
    return _keyed(offers.unionByName(asks), CreditAnswers(keep_seconds), CREDITS_TYPE)
