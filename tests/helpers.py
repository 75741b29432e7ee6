from datetime import datetime, timedelta, timezone

from glosswell.schema import COMMENT_SCHEMA

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
START = 1_514_764_800


def comment(comment_id, depth, user, reply_to="0", at=0.0, likes=0, picked=False, article="a"):
    """A comment row; ``at`` is seconds after START."""
    when = EPOCH + timedelta(seconds=START + at)
    return (
        when, article, 100, comment_id, "comment", when, depth, picked, reply_to, "", likes, "s", "n", user, "x",
    )


def comments(spark, rows):
    return spark.createDataFrame(rows, COMMENT_SCHEMA)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())
