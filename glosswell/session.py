"""Session settings the jobs rely on.

Cluster sizing (executors, memory, shuffle partitions) belongs to the submitter; only what
changes results or skew behaviour is touched here.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Make ``spark`` fit for the jobs and return it.

    Windows are aligned to the Unix epoch in UTC and source timestamps carry no zone, so the
    session zone has to be UTC. Adaptive execution sizes the shuffles and splits skewed joins.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, or None where it names none."""
    return spark.conf.get("spark.checkpoint.dir", None)


def use_state_store(spark: SparkSession) -> SparkSession:
    """Keep streaming state in RocksDB: per-user and per-comment state outgrows the heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark
