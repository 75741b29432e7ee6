"""Running totals per key that never reset, without giving a whole key to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_slice(at: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(at) / F.lit(seconds))


def running_totals(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, str],
    slice_by: Column,
    maxima: dict[str, str] | None = None,
) -> DataFrame:
    """Add, per key, the sum of each source column up to and including the row.

    ``totals`` maps result column to source column, ``maxima`` does so for running maxima. ``slice_by`` must not decrease along
    ``order``. A key is cut into slices: the total inside a slice comes from a window over
    (key, slice), what came before it from a prefix sum over one summary row per slice. The
    summary is the last local total of each slice, read off the windowed rows, so rows are
    shuffled once and everything above them is computed once; only summaries move again.
    """
    group = [*keys, "slice"]
    maxima = maxima or {}
    # Rows without a key have no total. Said up front, both sides of the join below filter alike
    # and share one shuffle; left to the join, each side would get its own filter and shuffle.
    sliced = rows.withColumn("slice", slice_by)
    for name in group:
        sliced = sliced.where(F.col(name).isNotNull())
    inside = (
        Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.select(
        "*",
        *[F.sum(source).over(inside).alias(name) for name, source in totals.items()],
        *[F.max(source).over(inside).alias(name) for name, source in maxima.items()],
    )
    in_slice = local.groupBy(*group).agg(
        F.max_by(F.struct(*totals, *maxima), F.struct(*order)).alias("in_slice")
    )
    carried = in_slice.select(
        *group,
        *[
            F.coalesce(F.sum(f"in_slice.{name}").over(earlier), F.lit(0)).alias(f"before_{name}")
            for name in totals
        ],
        *[F.max(f"in_slice.{name}").over(earlier).alias(f"before_{name}") for name in maxima],
    )
    return local.join(carried, group).select(
        *rows.columns,
        *[(F.col(name) + F.col(f"before_{name}")).alias(name) for name in totals],
        *[F.greatest(name, f"before_{name}").alias(name) for name in maxima],
    )
