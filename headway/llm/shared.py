"""Tables in the folder that all executors share, and groups of linked documents."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Spark removes the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def set_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Rows handed to Python at once; texts are long, so Spark's 10,000 would need much memory.

    Python workers also look for this package in the place where the driver has it.
    """
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if here not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([here, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, safe from lost executors.

    Its shuffle files go once it is written; nothing reads them again.
    """
    spark = df.sparkSession
    path, before = shared_folder(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.folder = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made and that no later step reads, so that they take no more disk."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def respelled(df: DataFrame, column: str) -> DataFrame:
    """The same rows, with a column (bigint) Spark no longer takes to be the one the frame is grouped by.

    A join with the frame then shuffles both sides, so Spark can split a hot key of the other one.
    """
    return df.withColumn(column, F.bitwise_not(F.bitwise_not(column)))


def components(links: DataFrame) -> DataFrame:
    """Smallest node each node of ``links`` (a, b: bigint) reaches, as (node, label).

    Alternating star contraction: each node hands its smallest neighbour to the larger ones, then
    to the smaller ones, until every node hangs on the smallest of its component.  All steps are
    joins and aggregations; links with a null end are ignored.  A node of very many links is split
    over tasks in the joins, and met in part before the shuffle in the groupings.
    """
    spark = links.sparkSession
    edges = written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = respelled(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "a")
        large = (
            both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(respelled(lowest, "a"), "a")
        small = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionAll(lowest.select("a", F.col("m").alias("b"))).distinct(), "links")
        # The edges shrink towards one per node and stay as they are once all hang on their root.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        roots.select(F.col("b").alias("node"), F.col("b").alias("label"))
    )
