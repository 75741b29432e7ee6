"""Connected components of a list of links, as a fixed number of joins per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """id, component: the smallest id reachable from each id that occurs in links (a, b).

    Every round hangs each id's larger neighbours under its smallest one, then its smaller ones; a
    component becomes a star in about as many rounds as the logarithm of its width. An id with many
    neighbours meets one row in each join. Rows with a null or with a = b link nothing. Rounds are
    written, so that lineage stays short.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct()
    edges = written(edges, "links")
    before = None
    while True:
        both = edges.union(edges.select("high", "low")).toDF("id", "other")
        lowest = both.groupBy("id").agg(F.min("other").alias("least")).select("id", F.least("id", "least").alias("least"))
        large = both.where("other > id").join(lowest, "id").select(F.col("other").alias("id"), "least").where("id <> least").distinct()
        under = large.groupBy("id").agg(F.min("least").alias("root"))
        small = (
            large.join(under, "id")
            .select(F.col("root").alias("low"), F.explode(F.array("id", "least")).alias("high"))
            .where("low <> high")
            .distinct()
        )
        edges = written(small, "links")
        state = edges.agg(F.count("*"), F.sum(F.hash("low", "high").cast("long")), F.count_distinct("high")).first()
        if state == before and state[0] == state[2]:
            break
        before = state
    roots = edges.select("low").distinct().select(F.col("low").alias("id"), F.col("low").alias("component"))
    return edges.select(F.col("high").alias("id"), F.col("low").alias("component")).union(roots)
