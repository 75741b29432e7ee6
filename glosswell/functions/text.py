"""Result lines and packed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = ", "
PACK = ";"


def pack_author(user_id: Column, parent_user_id: Column) -> Column:
    """``user`` or ``user;parent``: the single-string form of an author entry."""
    return F.concat_ws(PACK, user_id, parent_user_id)


def unpack_author(packed: Column) -> tuple[Column, Column]:
    """Author and parent author of a packed entry; anything past the second part is ignored."""
    parts = F.split(packed, PACK)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def ranking_lines(ranked: DataFrame, key: Column, value: Column) -> DataFrame:
    """One line per window: start seconds, then the (key, value) pairs by rank.

    ``ranked`` already holds only the k best rows of each window, so the array that is sorted
    here has at most k entries.
    """
    pairs = F.sort_array(F.collect_list(F.struct(F.col("rank"), F.concat_ws(SEPARATOR, key, value).alias("pair"))))
    return (
        ranked.groupBy("window_start")
        .agg(pairs.alias("pairs"))
        .select(
            "window_start",
            F.concat_ws(
                SEPARATOR, F.unix_seconds("window_start").cast("string"), F.col("pairs.pair")
            ).alias("line"),
        )
    )


def row_lines(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One line per window out of fixed columns."""
    return rows.select(
        "window_start",
        F.concat_ws(
            SEPARATOR,
            F.unix_seconds("window_start").cast("string"),
            *[F.col(c).cast("string") for c in columns],
        ).alias("line"),
    )
