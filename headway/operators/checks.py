"""Guards, required fields, listings and feed completeness."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from headway.functions import path_part
from headway.schemas import FEED, LEDGER_KEY, LISTED_TYPES, REQUIRED_TYPES


def require_nonempty(df: DataFrame, message: str) -> DataFrame:
    """The frame itself, or an error when it has no row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def required_error(columns: Sequence[str] = LEDGER_KEY) -> Column:
    """Message for the first column that is absent or empty; empty text when all are there."""
    checks = [
        F.when(F.col(name).isNull(), F.lit(f"Campo requerido {name} no encontrado")).when(
            F.col(name).cast("string") == "", F.lit(f"Campo {name} está vacío")
        )
        for name in columns
    ]
    return F.coalesce(*checks, F.lit(""))


def validate_required(df: DataFrame, columns: Sequence[str] = LEDGER_KEY) -> DataFrame:
    """Add ``is_valid`` and ``message``; the required columns become text."""
    texts = {name: F.col(name).cast("string") for name in columns}
    checked = df.withColumns(texts).withColumn("message", required_error(columns))
    return checked.withColumn("is_valid", F.col("message") == "")


def with_feed_columns(listing: DataFrame, path: str = "path") -> DataFrame:
    """Add the feed columns and the file type found in each path."""
    kind = F.regexp_extract(path, r"GTFS/([^/]+)/", 1)
    return listing.withColumns(
        {**{name: path_part(path, name) for name in FEED}, "gtfs_type": kind}
    )


def filter_listing(
    listing: DataFrame,
    feed: tuple[str, str, str] | None = None,
    types: Sequence[str] = LISTED_TYPES,
    path: str = "path",
) -> DataFrame:
    """Text files of the listed types, of one feed or of all."""
    found = listing.where(F.col(path).endswith(".txt"))
    if feed is not None:
        for name, value in zip(FEED, feed):
            found = found.where(path_part(path, name) == value)
    if types:
        folders = "|".join(re.escape(kind) for kind in types)
        found = found.where(F.col(path).rlike(f"GTFS/({folders})/"))
    return found


def feed_folders(listing: DataFrame, path: str = "path") -> DataFrame:
    """Distinct (feed, type, folder): the folder as storage spells it, without the type before it."""
    folder = "/".join(f"{name}=[^/]+" for name in FEED)
    found = with_feed_columns(listing, path).withColumn("folder", F.regexp_extract(path, f"GTFS/[^/]+/({folder})/", 1))
    return found.where("folder <> ''").select(*FEED, "gtfs_type", "folder").distinct()


def count_by_folder(listing: DataFrame, path: str = "path") -> DataFrame:
    """Files per folder."""
    folder = F.regexp_replace(path, "/[^/]*$", "")
    return listing.groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files"))


def feed_completeness(
    listing: DataFrame,
    required: Sequence[str] = REQUIRED_TYPES,
    path: str = "path",
    exact_names: bool = True,
) -> DataFrame:
    """Per feed the required types that are present and missing, and whether it is complete.

    Only feeds whose first required type is there are candidates.  With ``exact_names`` a type
    counts when its file ``<type>.txt`` exists, else when its folder holds any file.  Keys are
    compared as they are and not as folder names spell them.  The state per feed is one flag per
    type, so the size of a feed's listing does not matter.
    """
    files = with_feed_columns(listing, path).where(
        " AND ".join(f"{name} <> ''" for name in FEED)
    )
    if exact_names:
        folder = "/".join(f"{name}=[^/]+" for name in FEED)
        in_place = F.col(path).rlike(f"GTFS/[^/]+/{folder}/[^/]+$")
        files = files.where(in_place & (F.substring_index(path, "/", -1) == F.concat(F.lower("gtfs_type"), F.lit(".txt"))))
    flags = files.groupBy(*FEED).agg(
        *[F.max(F.col("gtfs_type") == kind).alias(f"has_{kind}") for kind in required]
    )
    kinds = sorted(required)
    present = [F.when(F.col(f"has_{kind}"), F.lit(kind)) for kind in kinds]
    missing = [F.when(~F.col(f"has_{kind}"), F.lit(kind)) for kind in kinds]
    return flags.where(f"has_{required[0]}").select(
        *FEED,
        F.array_compact(F.array(*present)).alias("gtfs_types"),
        F.array_compact(F.array(*missing)).alias("missing_types"),
    ).withColumn("is_complete", F.size("missing_types") == 0)
