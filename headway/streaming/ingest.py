"""Process the feeds whose files have arrived since the last run."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.checks import feed_completeness, feed_folders
from headway.operators.joins import anti_filter
from headway.plans.products import macro, macro_stops
from headway.schemas import FEED
from headway.sources.commits import commit_product
from headway.sources.listing import list_files, literal
from headway.sources.tables import read_checked

#: Takes the feeds of a batch and its number.
Handler = Callable[[DataFrame, int], None]

_FILES = "path string, modificationTime timestamp, length long, content binary"


def folders_of(feeds: DataFrame) -> dict[str, list[str]]:
    """Folders of each type; the driver needs them as the paths of the scans."""
    found = defaultdict(list)
    for row in feeds.select("folder", F.explode("types").alias("type")).toLocalIterator():
        found[row.type].append(row.folder)
    return found


def write_products(spark: SparkSession, root: str, target: str) -> Handler:
    """Handler that commits both products of the given feeds under the number of the batch.

    Only the feeds' own folders are read.  A feed that yields no rows any more is emptied; one with
    rows that cannot be read keeps what it had, and is listed below ``errors``.  A repeated batch
    commits the same.
    """

    def handle(feeds: DataFrame, batch_id: int) -> None:
        tables, errors = read_checked(spark, root, folders_of(feeds))
        errors.write.mode("overwrite").json(f"{target}/errors/batch={batch_id}")
        good = anti_filter(feeds.select(*FEED), errors.select(*FEED).distinct(), FEED)
        trips, routes = tables["trips"], tables["routes"]
        points = macro(trips, routes, tables.get("shapes"))
        calls = macro_stops(trips, routes, tables["stop_times"], tables["stops"])
        commit_product(points, good, f"{target}/MACRO", batch_id)
        commit_product(calls, good, f"{target}/MACRO_STOPS", batch_id)

    return handle


def complete_feeds(spark: SparkSession, root: str, touched: DataFrame, exact_names: bool = True) -> DataFrame:
    """The complete feeds among those of the touched paths: feed, folder and the types it has.

    Only the folders of the touched feeds are listed.
    """
    # One pattern per touched feed: what Spark keeps on the driver to list them.
    names = [row.folder for row in feed_folders(touched).select("folder").distinct().toLocalIterator()]
    if not names:
        return touched.sparkSession.createDataFrame([], ", ".join([*[f"{c} string" for c in FEED], "folder string", "types array<string>"]))
    files = list_files(spark, [f"{root.rstrip('/')}/GTFS/*/{literal(name)}" for name in names])
    complete = feed_completeness(files, exact_names=exact_names).where("is_complete").select(*FEED)
    folders = feed_folders(files).groupBy(*FEED, "folder").agg(F.collect_set("gtfs_type").alias("types"))
    return folders.join(complete, list(FEED), "left_semi")


def ingest_new_feeds(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    handle: Handler,
    exact_names: bool = True,
) -> StreamingQuery:
    """Watch the files under ``root`` and hand the complete feeds among the touched ones on.

    The stream only carries paths.  A feed is judged by all its files, not by those of the
    batch, so it does not matter if they arrive in different batches.  The feeds of a batch are
    written next to the checkpoint, with their folders and types: the handler reads them many
    times, and a repeated batch writes them again.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", "true")
        .load(f"{root.rstrip('/')}/GTFS")
        .select("path")
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        found = complete_feeds(spark, root, batch, exact_names)
        path = f"{checkpoint.rstrip('/')}-feeds/{batch_id}"
        found.write.mode("overwrite").parquet(path)
        feeds = spark.read.schema(found.schema).parquet(path)
        if not feeds.isEmpty():
            handle(feeds, batch_id)

    return (
        files.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
