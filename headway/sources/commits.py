"""Products on storage as commits: each replaces the rows of its feeds, down to none.

A product is a folder.  ``data/commit=<n>/`` holds the rows of a commit in feed folders and
``commits/commit=<n>/`` its manifest, one row per feed with the number of its rows.  A feed's rows are
those of the last commit that names it; one with no rows there is a tombstone.  The manifest is
written last, so rows without one are never seen.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from headway.operators.joins import semi_filter
from headway.schemas import FEED
from headway.sources.tables import pruned_by, write_feed_table

_MANIFEST = ", ".join([*[f"{name} string" for name in FEED], "n_rows bigint", "columns string", "commit bigint"])


def commit_product(rows: DataFrame, feeds: DataFrame, path: str, commit: int) -> None:
    """Make ``rows`` the rows of ``feeds``; a feed without any is emptied, rows of other feeds are left out.

    The commit with the highest number counts.  A repeated commit writes the same again, so a batch
    whose writer was lost can be run once more.
    """
    spark = rows.sparkSession
    base = path.rstrip("/")
    named = feeds.select(*FEED).distinct()
    data = f"{base}/data/commit={commit}"
    write_feed_table(semi_filter(rows, named, FEED), data, whole=True, n_feeds=named.count())
    kept = spark.read.schema(rows.schema).parquet(data)
    counts = kept.groupBy(*FEED).agg(F.count("*").alias("n_rows"))
    manifest = named.join(counts, list(FEED), "left").select(
        *FEED, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.lit(rows.schema.json()).alias("columns")
    )
    manifest.write.mode("overwrite").json(f"{base}/commits/commit={commit}")


def product_commits(spark: SparkSession, path: str) -> DataFrame:
    """All manifests: feed, number of rows, columns and commit."""
    return spark.read.schema(_MANIFEST).json(f"{path.rstrip('/')}/commits")


def live_feeds(spark: SparkSession, path: str) -> DataFrame:
    """The commit that holds each feed's rows; feeds that were emptied have none."""
    last = product_commits(spark, path).groupBy(*FEED).agg(
        F.max("commit").alias("commit"), F.max_by("n_rows", "commit").alias("n_rows")
    )
    return last.where("n_rows > 0")


def read_product(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the product as of the last commit of each feed.

    Feeds and commits are folders: which ones are read is found at run time, from the manifests.
    """
    newest = product_commits(spark, path).agg(F.max_by("columns", "commit")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"{path} has no commit")
    columns = T.StructType.fromJson(json.loads(newest))
    schema = T.StructType([*columns.fields, T.StructField("commit", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/data")
    return pruned_by(rows, live_feeds(spark, path), [*FEED, "commit"]).select(*columns.names)
