"""Popularity scores in whole cents.

A like weighs 0.30 points, 0.33 when the comment is an editors' pick, and a reply 0.70. Each is
a whole number of cents, so BIGINT sums are exact and do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cents per like, per like on an editors' pick, and per reply.
LIKE_CENTS = 30
PICKED_LIKE_CENTS = 33
REPLY_CENTS = 70


def like_cents(recommendations: Column, editors_selection: Column) -> Column:
    """Cents a direct comment earns its author."""
    weight = F.when(editors_selection, F.lit(PICKED_LIKE_CENTS)).otherwise(F.lit(LIKE_CENTS))
    return recommendations.cast("bigint") * weight.cast("bigint")


def points(cents: Column) -> Column:
    """Cents as text with two decimals, exact for any size."""
    return (cents.cast("decimal(38,0)") / F.lit(100)).cast("decimal(38,2)").cast("string")


def compounded_cents(replies: Column, likes: Column) -> Column:
    """Sum of a user's successive reply totals, plus their like cents so far.

    The running ranking adds up running totals: after the n-th reply the reply part is
    70 + 140 + ... + 70 n = 35 n (n + 1). It grows with the square of n, hence DECIMAL.
    """
    n = replies.cast("decimal(19,0)")
    half = F.lit(REPLY_CENTS // 2).cast("decimal(3,0)")
    return (n * (n + F.lit(1).cast("decimal(1,0)")) * half + likes.cast("decimal(19,0)")).cast(
        "decimal(38,0)"
    )
