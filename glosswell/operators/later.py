"""The least value among all later rows, without one ordered pass over everything.

Numbers are read as digits of a large base. What is later than a number has, at some digit, the same digits
before it and a greater one there; so the least later value is the least over the digits of what
the blocks to the right within the same parent block hold. A parent has at most a base of blocks, and
that is all that is ever sorted together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Digits of 10 bits, four of them after a shift that makes all numbers positive.
DIGIT_BITS, DIGITS = 10, 4
SHIFT = 1 << (DIGIT_BITS * DIGITS - 1)


def least_later(rows: DataFrame, number: str, value: str, result: str) -> DataFrame:
    """``rows``, one for each ``number``, with the least ``value`` of greater numbers as ``result``.

    Nulls in ``value`` are passed over; ``result`` is null where no greater number has one. Numbers
    lie within 2 ** 39 of zero.
    """
    placed = F.col(number) + F.lit(SHIFT)
    blocks = F.array(
        *[F.struct(F.lit(d).alias("digit"), F.shiftright(placed, DIGIT_BITS * d).alias("block")) for d in range(DIGITS)]
    )
    right = (
        Window.partitionBy("digit", "parent").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    )
    least = (
        rows.select(F.inline(blocks), value)
        .groupBy("digit", "block")
        .agg(F.min(value).alias("least"))
        .withColumn("parent", F.shiftright("block", DIGIT_BITS))
        .select("digit", "block", F.min("least").over(right).alias("least"))
        .where(F.col("least").isNotNull())
    )
    later = (
        rows.select(number, F.inline(blocks))
        .join(least, ["digit", "block"])
        .groupBy(number)
        .agg(F.min("least").alias(result))
    )
    return rows.join(later, number, "left")
