"""Latest-version lookup: what did an entry say at a given time?

Rows carry a key and a time; some are versions of what their key says, others ask for the newest version
that is not younger than they are. A join on the key would pair each question with every version of it;
here versions and questions are sorted together and the last version seen is taken, so the work is
linear in the rows, for repeated keys as well.

The time axis of a key is cut into buckets of a fixed width. Each (key, bucket) is sorted on its own,
and opens with a row for the last version before it. Those rows come from a pass over one summary row
per bucket, which is aggregated before its shuffle. So a key that holds most of the rows is as many
groups as it has busy buckets, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Width of a bucket. It moves work and never changes a result: what one key brings within it is one
# sort, which may spill. Narrow buckets cost a summary row each.
BUCKET_SECONDS = 3_600
NULL_SPREAD = 1 << 20


def latest_version(rows: DataFrame, key: str, at: str, version: str, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``rows`` plus a column ``found``: of their key, the newest version not younger than the row.

    ``version`` is a struct column whose first field is the time, null on rows that are none. A version counts
    for rows of the same instant; versions of one key and instant are ordered by their fields. Null
    keys have no versions and find none.
    """
    spread = F.pmod(F.xxhash64(at), F.lit(NULL_SPREAD))
    bucket = F.floor(F.unix_seconds(at) / F.lit(bucket_seconds))
    placed = rows.withColumns(
        {
            "_key": F.coalesce(key, F.lit("")),
            "_keyless": F.col(key).isNull(),
            "_bucket": F.coalesce(F.when(F.col(key).isNull(), spread).otherwise(bucket), F.lit(0)),
        }
    )
    group = ["_key", "_keyless", "_bucket"]
    earlier = Window.partitionBy("_key", "_keyless").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.where(~F.col("_keyless"))
        .groupBy(*group)
        .agg(F.max(version).alias("_last"))
        .select(*group, F.last("_last", ignorenulls=True).over(earlier).alias(version))
        .where(F.col(version).isNotNull())
    )
    opening = carried.withColumn("_opens", F.lit(True))
    both = placed.withColumn("_opens", F.lit(False)).unionByName(opening, allowMissingColumns=True)
    so_far = (
        Window.partitionBy(*group)
        .orderBy(F.desc("_opens"), at, F.col(version).isNull(), version)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        both.withColumn("found", F.last(version, ignorenulls=True).over(so_far))
        .where(~F.col("_opens"))
        .select(*rows.columns, "found")
    )
