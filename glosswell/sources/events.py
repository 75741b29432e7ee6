"""The ``events`` test table seen as comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswell.schema import COMMENT_FIELDS


def comments_from_events(events: DataFrame) -> DataFrame:
    """Comments derived from events, plus the ingest time the reports need.

    The event id names the comment, ``k`` of the props the article, the event type the depth;
    a reply answers the event ``k + 1`` ids earlier. The zone-less event time is taken as UTC.
    """
    at = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("bigint")
    user = F.col("user_id").cast("string")
    depth = F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "signup", 3).otherwise(1)
    columns = {
        "approve_date": F.timestamp_micros(F.unix_micros(at) + F.col("event_id") % 600 * 1_000_000),
        "article_id": k.cast("string"),
        "article_word_count": (k + 100).cast("int"),
        "comment_id": F.col("event_id").cast("string"),
        "comment_type": F.col("event_type"),
        "create_date": at,
        "depth": depth,
        "editors_selection": F.col("event_id") % 10 == 0,
        "in_reply_to": (F.col("event_id") - 1 - k).cast("string"),
        "parent_user_display_name": F.lit(""),
        "recommendations": F.floor("value").cast("int"),
        "section_name": F.concat(F.lit("section "), (k % 10).cast("string")),
        "user_display_name": F.concat(F.lit("user "), user),
        "user_id": user,
        "user_location": F.lit("UTC"),
    }
    ingest = F.timestamp_micros(F.unix_micros(at) + F.col("event_id") % 600 * 1_000)
    return events.select(*[columns[c].alias(c) for c in COMMENT_FIELDS], ingest.alias("ingest_ts"))


def read_event_comments(spark: SparkSession, folder: str) -> DataFrame:
    return comments_from_events(spark.read.parquet(f"{folder}/events.parquet"))


# How the line of an event is spoiled, by event id modulo the number of entries.
LINE_VARIANTS = (
    "plain",
    "quoted",
    "newline",
    "few_tokens",
    "extra_tokens",
    "decimal_date",
    "padded_depth",
    "signed_likes",
    "count_overflow",
    "empty_date",
    "upper_flag",
    "odd_flag",
    "bad_user",
    "odd_quote",
    "header",
    "plain_reply",
    "null_line",
)


def lines_from_events(events: DataFrame) -> DataFrame:
    """Comment lines derived from events, good and bad ones mixed: a ``value`` column."""
    comments = comments_from_events(events).withColumn(
        "variant", F.pmod(F.col("comment_id").cast("bigint"), F.lit(len(LINE_VARIANTS)))
    )

    def variant(name: str):
        return F.col("variant") == LINE_VARIANTS.index(name)

    approved = F.unix_seconds("approve_date").cast("string")
    fields = [
        F.when(variant("decimal_date"), F.concat(approved, F.lit(".0")))
        .when(variant("empty_date"), F.lit(""))
        .otherwise(approved),
        F.col("article_id"),
        F.when(variant("count_overflow"), F.lit("3000000000")).otherwise(
            F.col("article_word_count").cast("string")
        ),
        F.col("comment_id"),
        F.col("comment_type"),
        F.unix_seconds("create_date").cast("string"),
        F.when(variant("padded_depth"), F.concat(F.lit(" "), F.col("depth").cast("string"), F.lit(" "))).otherwise(
            F.col("depth").cast("string")
        ),
        F.when(variant("upper_flag"), F.lit("TRUE"))
        .when(variant("odd_flag"), F.lit("yes"))
        .when(F.col("editors_selection"), F.lit("True"))
        .otherwise(F.lit("False")),
        F.col("in_reply_to"),
        F.col("parent_user_display_name"),
        F.concat(F.when(variant("signed_likes"), F.lit("+")).otherwise(F.lit("")), F.col("recommendations").cast("string")),
        F.when(variant("quoted"), F.lit('"Arts, X"')).otherwise(F.col("section_name")),
        F.col("user_display_name"),
        F.when(variant("bad_user"), F.concat("user_id", F.lit("a"))).otherwise(F.col("user_id")),
        F.when(variant("quoted"), F.lit('"Rome, ""IT"""')).otherwise(F.col("user_location")),
    ]
    line = F.concat_ws(",", *fields)
    value = (
        F.when(variant("newline"), F.concat(line, F.lit("\n")))
        .when(variant("few_tokens"), F.concat(F.col("comment_id"), F.lit(",y")))
        .when(variant("extra_tokens"), F.concat(line, F.lit(",zzz")))
        .when(variant("odd_quote"), F.concat(F.col("comment_id"), F.lit(',"y')))
        .when(variant("null_line"), F.lit(None).cast("string"))
        .when(variant("header"), F.lit("approveDate,articleID,articleWordCount"))
        .otherwise(line)
    )
    # explode of one element: readers of the column do not build the line again.
    return comments.select(F.explode(F.array(value)).alias("value"))
