"""Find the feeds below a storage root and check that they are complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.functions import feed_id
from headway.operators.checks import feed_completeness
from headway.schemas import FEED, LEDGER_KEY, REQUIRED_TYPES
from headway.sources.listing import list_files


def manifest_of(
    listing: DataFrame,
    as_of: str,
    required: Sequence[str] = REQUIRED_TYPES,
    exact_names: bool = True,
) -> DataFrame:
    """Pending entries of the complete feeds of a listing."""
    complete = feed_completeness(listing, required, exact_names=exact_names).where("is_complete")
    return complete.select(
        feed_id(*FEED).alias("id"),
        *[F.col(name).alias(key) for name, key in zip(FEED, LEDGER_KEY)],
        F.lit("pending").alias("status"),
        F.lit(as_of).alias("discovery_time"),
        "gtfs_types",
    )


def discover_feeds(
    spark: SparkSession, root: str, as_of: str, exact_names: bool = True
) -> DataFrame:
    """Manifest of the feeds under ``root``: one listing and one aggregation."""
    return manifest_of(list_files(spark, root), as_of, exact_names=exact_names)


def write_manifest(manifest: DataFrame, path: str, as_of: str, root: str) -> None:
    """Write the entries and, next to them, their number with time and place."""
    manifest.write.mode("overwrite").json(f"{path.rstrip('/')}/combinations")
    summary = manifest_summary(manifest, as_of, root)
    summary.write.mode("overwrite").json(f"{path.rstrip('/')}/summary")


def manifest_summary(manifest: DataFrame, as_of: str, root: str) -> DataFrame:
    """One row with the number of feeds, the time and the place."""
    return manifest.agg(F.count("*").alias("total")).select(
        "total", F.lit(as_of).alias("timestamp"), F.lit(root).alias("root")
    )
