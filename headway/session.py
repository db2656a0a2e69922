"""Settings the plans are written for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Feeds whose files a task that writes feed folders keeps open at once.
OPEN_FEEDS = 8

SETTINGS = {
    # Runtime re-planning: broadcast by measured size, split skewed join partitions, coalesce.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose partitions are all small enough build a hash map instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Feed keys are text: "007" must not become 7.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Rewriting one feed must leave the others in place.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A task that writes feed folders keeps the files of so many feeds open, and sorts its rows by
    # feed only where it has more.
    "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FEEDS),
    "spark.sql.session.timeZone": "UTC",
    # Building a plan takes half as long when the source line of each expression is not recorded.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder every executor can reach: below ``spark.checkpoint.dir``, or below the warehouse
    where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
