"""Raw comment lines to typed comments and rejects, in column expressions only.

A line is split at the commas that an even number of double quotes follows; quotes stay in the
values. Fields are positional and tokens past the fifteenth are ignored. Numbers are strict (sign
and digits, in range), the user id is digits only. One bad field rejects the whole line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glosswell.schema import COMMENT_FIELDS, COMMENT_SCHEMA

# Separator rule, number and user id formats, first word of the header line.
QUOTED_SPLIT = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
NUMBER = r"\A[+-]?[0-9]+\z"
USER_ID = r"\A[0-9]+\z"
HEADER = "approveDate,"

# Seconds a Spark timestamp, a count of microseconds in 64 bits, can hold.
MIN_SECONDS = -9_223_372_036_854
MAX_SECONDS = 9_223_372_036_854

# Fields a token can fail; the other ones are taken as they are.
CHECKED_FIELDS = [
    f.name for f in COMMENT_SCHEMA.fields if not isinstance(f.dataType, T.StringType) or f.name == "user_id"
]

MARK = "\u0001"


def split_line(line: Column) -> Column:
    """Tokens of a line.

    A line without quotes is split at every comma. Otherwise the line is cut at its quotes: the
    pieces an even number of quotes follows are every second one counted from the end, so the
    commas in those become marks and the line is split at the marks, in one pass. The
    look-ahead pattern states the same rule but rescans the rest of the line at each comma; it
    remains for lines that contain the mark themselves.
    """
    return (
        F.when(~F.contains(line, F.lit('"')), F.split(line, ",", -1))
        .when(F.contains(line, F.lit(MARK)), F.split(line, QUOTED_SPLIT, -1))
        .otherwise(F.split(_mark_separators(line), MARK, -1))
    )


def _mark_separators(line: Column) -> Column:
    def joined(pieces: Column) -> Column:
        def marked(piece: Column, i: Column) -> Column:
            separates = (F.size(pieces) - i) % 2 == 1
            return F.when(separates, F.translate(piece, ",", MARK)).otherwise(piece)

        return F.array_join(F.transform(pieces, marked), '"')

    # The outer one-element transform binds the pieces, so they are made once per line.
    return F.transform(F.array(F.split(line, '"', -1)), joined)[0]


def _number(token: Column, kind: str) -> Column:
    return F.when(token.rlike(NUMBER), token.try_cast(kind))


def _raw_field(token: Column, field: T.StructField) -> Column:
    """A field out of its token, null where malformed; times are still epoch seconds."""
    if isinstance(field.dataType, T.TimestampType):
        return _number(token, "bigint")
    if isinstance(field.dataType, T.IntegerType):
        return _number(token, "int")
    if isinstance(field.dataType, T.BooleanType):
        return F.lower(token) == "true"
    if field.name == "user_id":
        return F.when(token.rlike(USER_ID), token)
    return token


def _field(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.TimestampType):
        seconds = F.col(field.name)
        return F.when(seconds.between(MIN_SECONDS, MAX_SECONDS), F.timestamp_seconds(seconds))
    return F.col(field.name)


def parse_lines(lines: DataFrame) -> DataFrame:
    """``value``, the typed comment fields, and ``reason``: null for a good line.

    The reason names what failed first: ``tokens`` or a field. A null line has no tokens. Header
    lines are left out. Works on tables and streams.
    """
    value = F.col("value")
    line = F.when(F.endswith(value, F.lit("\n")), F.rtrim(value, F.lit("\r\n"))).otherwise(value)
    # The one-element explode and inline pin their results: filters and columns above them use
    # the tokens and fields as they are, where a projection would be merged and work repeated.
    tokens = lines.where(~F.coalesce(value.startswith(HEADER), F.lit(False))).select(
        "value", F.explode(F.array(split_line(line))).alias("tokens")
    )
    raw = tokens.select(
        "value",
        F.size("tokens").alias("size"),
        F.inline(
            F.array(
                F.struct(
                    *[
                        _raw_field(F.get("tokens", F.lit(i)), field).alias(field.name)
                        for i, field in enumerate(COMMENT_SCHEMA.fields)
                    ]
                )
            )
        ),
    )
    typed = raw.select("value", "size", *[_field(f).alias(f.name) for f in COMMENT_SCHEMA.fields])
    reason = F.when(F.col("value").isNull() | (F.col("size") < len(COMMENT_FIELDS)), F.lit("tokens"))
    for name in CHECKED_FIELDS:
        reason = reason.when(F.col(name).isNull(), F.lit(name))
    return typed.select("value", *COMMENT_FIELDS, reason.alias("reason"))


def comments_of(parsed: DataFrame) -> DataFrame:
    """The good lines as comments."""
    return parsed.where(F.col("reason").isNull()).select(*COMMENT_FIELDS)


def rejects_of(parsed: DataFrame) -> DataFrame:
    """The bad lines with the reason."""
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")

