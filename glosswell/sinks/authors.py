"""The author record as a table: comment id to author and parent author, last write wins.

A stream adds an increment per micro-batch, dealt into parts by a hash of the comment id. Compaction folds
increments into a base, part by part, and writes those parts only that have any; a base part says up to
which batch it holds. Reading takes the newest base of every part and the increments after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from glosswell.sinks.files import claim, folders

PARTS = 64
_ENTRY = ("create_date", "user_id", "parent_user_id")
_TYPE = "comment_id string, create_date timestamp, user_id string, parent_user_id string"


def _last_write(entries: DataFrame, *order: str) -> DataFrame:
    last = F.max_by(F.struct(*_ENTRY), F.struct(*order)).alias("last")
    return entries.groupBy("part", "comment_id").agg(last).select("part", "comment_id", "last.*")


def upsert_authors(entries: DataFrame, folder: str, checkpoint: str, parts: int = PARTS) -> DataStreamWriter:
    """Write a stream of author entries, reduced to the last one per comment and batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        claim(batch, folder)
        dealt = batch.dropna(subset=["comment_id", "user_id"]).withColumn("part", F.pmod(F.xxhash64("comment_id"), F.lit(parts)))
        _last_write(dealt, *_ENTRY).write.mode("overwrite").partitionBy("part").parquet(f"{folder}/increments/batch={batch_id}")

    return (
        entries.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(handle)
    )


def _places(spark: SparkSession, folder: str, kind: str) -> list[tuple[int, int, str]]:
    """(number, part, path) of every part there is under ``increments`` or ``base``, of finished writes."""
    found = []
    for written in folders(spark, f"{folder}/{kind}"):
        inside = folders(spark, written)
        if any(x.endswith("/_SUCCESS") for x in inside):
            number = int(written.rsplit("=", 1)[1])
            found += [(number, int(x.rsplit("=", 1)[1]), x) for x in inside if "/part=" in x]
    return found


def _read(spark: SparkSession, places: list[tuple[int, int, str]], kind: str) -> DataFrame:
    """The rows of these places with their batch and part."""
    schema = f"{_TYPE}, {kind} bigint, part bigint"
    if not places:
        return spark.createDataFrame([], schema)
    base = places[0][2].rsplit(f"/{kind}=", 1)[0]
    return spark.read.schema(schema).option("basePath", base).parquet(*[path for _, _, path in places])


def _current(spark: SparkSession, folder: str) -> tuple[list, list]:
    """The newest base of every part, and the increments that came after it."""
    newest = {}
    for place in sorted(_places(spark, folder, "base")):
        newest[place[1]] = place
    after = [p for p in _places(spark, folder, "increments") if p[0] > newest.get(p[1], (-1,))[0]]
    return list(newest.values()), after


def read_authors(spark: SparkSession, folder: str) -> DataFrame:
    """The record as it stands: ``comment_id, create_date, user_id, parent_user_id``, one row per comment.
    Of all batches the last one that wrote a comment id counts."""
    base, after = _current(spark, folder)
    held = _read(spark, base, "upto").withColumnRenamed("upto", "batch")
    every = held.unionByName(_read(spark, after, "batch"))
    return _last_write(every, "batch", *_ENTRY).drop("part")


def compact_authors(spark: SparkSession, folder: str) -> int:
    """Fold increments into the base; the number of parts that were written. The stream may go on meanwhile.

    A compaction that broke off has no success mark and is written again.
    """
    base, after = _current(spark, folder)
    if not after:
        return 0
    upto = max(number for number, _, _ in after)
    changed = {part for _, part, _ in after}
    held = _read(spark, [p for p in base if p[1] in changed], "upto").withColumnRenamed("upto", "batch")
    folded = _last_write(held.unionByName(_read(spark, after, "batch")), "batch", *_ENTRY)
    folded.write.mode("overwrite").partitionBy("part").parquet(f"{folder}/base/upto={upto}")
    return len(changed)
