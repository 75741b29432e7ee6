"""Who gets credit for a reply: authors of comments, parents and grandparents.

A thread has three levels that count. Direct comments and replies to them are on record with
their author; a reply of any depth other than 1 credits the author of the comment it answers
and, if that one is itself a reply on record, the author one level further up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosswell.functions.scores import REPLY_CENTS
from glosswell.operators.lookup import BUCKET_SECONDS, latest_version
from glosswell.schema import DIRECT, REPLY


def answered(comments: DataFrame, keep: tuple[str, ...] = (), bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every comment that may be credited or give credit, once as a version of itself and, if it is no
    direct one, once as a question for what it answers: ``role, key, at, version, comment_id, user_id, depth,
    keep..., found``. One scan gives both, and both share the shuffle of the lookup.
    """
    own = [F.col(c) for c in ("comment_id", "user_id", "depth", *keep)]
    version = F.struct(F.col("create_date").alias("since"), "user_id")
    known = F.col("depth").isin(DIRECT, REPLY) & F.col("comment_id").isNotNull() & F.col("user_id").isNotNull()

    none = F.lit(None).cast(comments.select(version.alias("v")).schema["v"].dataType)

    def role(name: str, holds: Column, key: str, said: Column) -> Column:
        return F.struct(
            F.when(holds, F.lit(name)).alias("role"),
            F.col(key).alias("key"),
            F.col("create_date").alias("at"),
            said.alias("version"),
            *own,
        )

    roles = F.array(role("says", known, "comment_id", version), role("asks", F.col("depth") != DIRECT, "in_reply_to", none))
    rows = comments.select(F.inline(roles)).where(F.col("role").isNotNull())
    return latest_version(rows, "key", "at", "version", bucket_seconds)


def author_versions(comments: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every entry of the author record: ``comment_id, create_date, user_id, parent_user_id``.

    The parent is null for direct comments and for replies whose parent was not on record.
    """
    rows = answered(comments, bucket_seconds=bucket_seconds)
    entry = ((F.col("role") == "says") & (F.col("depth") == DIRECT)) | ((F.col("role") == "asks") & (F.col("depth") == REPLY))
    parent = F.when(F.col("role") == "asks", F.col("found.user_id")).alias("parent_user_id")
    return (
        rows.where(entry)
        .select("comment_id", F.col("at").alias("create_date"), "user_id", parent)
        .dropna(subset=["comment_id", "user_id"])
    )


def latest_authors(entries: DataFrame) -> DataFrame:
    """One row per comment id, the last entry written: ``comment_id, user_id, parent_user_id``."""
    last = F.max(F.struct("create_date", "user_id", "parent_user_id")).alias("last")
    return entries.groupBy("comment_id").agg(last).select(
        "comment_id", "last.user_id", "last.parent_user_id"
    )


def reply_credits(
    comments: DataFrame, keep: tuple[str, ...] = (), bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """One row per credit: ``reply_id, hop, user_id, cents, create_date`` and the ``keep`` columns.

    Hop 1 is the author answered, hop 2 the author one level up. Time is that of the reply.
    """
    # One lookup answers all questions: what a reply answers, and what that one answers itself. The
    # second hop joins a reply to the answer that its parent got, so a comment's own parent is
    # looked up once per comment; a busy comment is one row on that side, and the other may be split.
    asked = answered(comments, keep, bucket_seconds).where(F.col("role") == "asks")
    # Both sides of the join name the same columns, so that they read one shuffle of the lookup: the
    # conditions in ``named`` always hold, and the columns beside the author above only order equals.
    named = (F.col("depth") != DIRECT) & (F.length(F.concat_ws("", "user_id", "comment_id")) >= 0)
    first = asked.where(F.col("found").isNotNull() & named).select(
        F.col("comment_id").alias("reply_id"),
        F.col("at").alias("create_date"),
        *keep,
        F.col("key").alias("parent_id"),
        F.col("found.since").alias("parent_at"),
        F.col("found.user_id").alias("parent_user"),
    )
    above = (
        asked.where((F.col("depth") == REPLY) & F.col("found").isNotNull())
        .groupBy(F.col("comment_id").alias("parent_id"), F.col("at").alias("parent_at"), F.col("user_id").alias("parent_user"))
        .agg(F.max(F.struct("found.user_id", "found.since", "key", *keep)).alias("above"))
    )
    resolved = first.join(above, ["parent_id", "parent_at", "parent_user"], "left")
    return (
        resolved.select(
            "reply_id",
            "create_date",
            *keep,
            F.posexplode(F.array("parent_user", "above.user_id")).alias("pos", "user_id"),
        )
        .where(F.col("user_id").isNotNull())
        .select(
            "reply_id",
            (F.col("pos") + F.lit(1)).alias("hop"),
            "user_id",
            F.lit(REPLY_CENTS).cast("bigint").alias("cents"),
            "create_date",
            *keep,
        )
    )
