"""The comment record: one row per reader comment, flat, fifteen fields."""

from pyspark.sql import types as T

# The field order of a comment line. The text before each type is the column name.
COMMENT_SCHEMA = T.StructType(
    [
        T.StructField("approve_date", T.TimestampType()),
        T.StructField("article_id", T.StringType()),
        T.StructField("article_word_count", T.IntegerType()),
        T.StructField("comment_id", T.StringType()),
        T.StructField("comment_type", T.StringType()),
        T.StructField("create_date", T.TimestampType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("editors_selection", T.BooleanType()),
        T.StructField("in_reply_to", T.StringType()),
        T.StructField("parent_user_display_name", T.StringType()),
        T.StructField("recommendations", T.IntegerType()),
        T.StructField("section_name", T.StringType()),
        T.StructField("user_display_name", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_location", T.StringType()),
    ]
)

COMMENT_FIELDS = COMMENT_SCHEMA.fieldNames()

# Depth of a comment in its thread.
DIRECT = 1  # answers the article
REPLY = 2  # answers a direct comment
