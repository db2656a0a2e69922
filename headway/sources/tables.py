"""Feed tables on storage.

Source files lie under ``<root>/GTFS/<TYPE>/explotation=…/contract=…/version=…/``.  Files of
different feeds may have other columns or another order, so feed folders are grouped by their
header line and each group is one native CSV scan with its own schema.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from headway.operators.columns import union_tables
from headway.operators.joins import anti_filter
from headway.schemas import FEED, SOURCES
from headway.session import OPEN_FEEDS, shared_dir
from headway.sources.listing import list_files, literal

# Texts that mean "no value" in a source file.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: Feeds that may be broadcast to prune a scan.
FEW_KEYS = 10_000


def table_root(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/GTFS/{name.upper()}"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).isDirectory(hadoop)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task; the rest of its split is not read."""
    for batch in batches:
        if len(batch):
            yield batch.slice(0, 1)
            return


def by_header(spark: SparkSession, files: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Group places by the first line of a file of theirs; ``files`` has ``path`` and ``place``.

    One job looks at all files, each in a task that stops after one line.  The driver sees the
    distinct headers and the places, which the scans need as their paths.  Empty files have none.
    """
    files = files.select("path", "place").persist()
    try:
        paths = [literal(row.path) for row in files.select("path").toLocalIterator()]
        if not paths:
            return {}
        # Files are not packed together, so each has its first line at the beginning of a task.
        with _setting(spark, "spark.sql.files.openCostInBytes", str(1 << 40)):
            lines = spark.read.text(paths).select(
                F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("header")
            )
            first = lines.mapInArrow(_first_rows, "path string, at bigint, header string").where("at = 0")
            # The same file is ``file:/a`` here, and ``file:///a`` there with its signs escaped once more.
            name = lambda c: F.regexp_replace(c, "^([a-z0-9]+:)/+", "$1/")
            plain = F.coalesce(F.try_url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "path")
            headed = files.select(name("path").alias("name"), "place").join(first.select(name(plain).alias("name"), "header"), "name")
            groups = headed.groupBy("header").agg(F.collect_list("place").alias("places")).collect()
    finally:
        files.unpersist()
    return {_columns(row.header): sorted(row.places) for row in groups}


def _columns(header: str) -> tuple[str, ...]:
    """Column names of a header line, as the CSV reader names them."""
    names = next(csv.reader([header.rstrip("\r")]), [])
    return tuple(name or f"_c{i}" for i, name in enumerate(names))


def _all_text(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    schema: T.StructType | None = None,
    null_words: Sequence[str] = NULL_WORDS,
    multi_line: bool = True,
    mixed_headers: bool = True,
    folders: Sequence[str] | None = None,
    bad_rows: str | None = None,
) -> DataFrame:
    """A source table of all feeds: the feed columns and the columns of ``schema``.

    All columns are read as text, picked by name and then cast; a value that does not fit its
    type is null.  A row with more or fewer fields than the header fails the job, so no row is lost or
    cut unseen.  With ``bad_rows`` it doesn't: a column of that name holds its text, and is null in good
    rows.  A quoted value may hold line breaks, in every table; ``multi_line=False`` lets Spark
    split large files that are known to have none, and a row broken by one is a bad one then.

    With ``folders`` (as in ``operators.checks.feed_folders``) only those of the table are listed and read.

    One file per feed folder tells the header of its folder, and with ``bad_rows`` every file its own;
    without ``mixed_headers`` one file tells it for all, which saves these looks.  Spark fails the job
    when a file has another header than it was taken to have.
    """
    schema = schema or SOURCES[name]
    base = table_root(root, name)
    places = base if folders is None else [f"{base}/{literal(folder)}" for folder in folders]
    if mixed_headers or bad_rows:
        folder = F.regexp_replace("path", "/[^/]*$", "")
        files = list_files(spark, places)
        if bad_rows:
            files = files.withColumn("place", F.col("path"))
        else:
            files = files.groupBy(folder.alias("place")).agg(F.min("path").alias("path"))
        groups = {header: [literal(place) for place in found] for header, found in by_header(spark, files).items()}
    else:
        reader = spark.read.option("header", "true").option("basePath", base)
        groups = {tuple(c for c in reader.csv(places).columns if c not in FEED): places if folders is not None else [base]}

    def scan(header: tuple[str, ...], paths: list[str]) -> DataFrame:
        fields = _all_text([*header, *([bad_rows] if bad_rows else []), *FEED])
        reader = (
            spark.read.schema(fields)
            .option("header", "true")
            .option("enforceSchema", "false")
            .option("mode", "PERMISSIVE" if bad_rows else "FAILFAST")
            .option("multiLine", multi_line)
            .option("escape", '"')
            .option("basePath", base)
        )
        if bad_rows:
            reader = reader.option("columnNameOfCorruptRecord", bad_rows)
        return reader.csv(paths).select(*FEED, *[column(f) for f in schema.fields if f.name in header], *([bad_rows] if bad_rows else []))

    def column(field: T.StructField) -> Column:
        text = F.col(field.name)
        value = F.when(~text.isin(*null_words), text) if null_words else text
        return value.try_cast(field.dataType).alias(field.name)

    frames = [scan(header, paths) for header, paths in groups.items()]
    if not frames:
        raise FileNotFoundError(base)
    missing = set(schema.names) - set().union(*[frame.columns for frame in frames])
    if missing:
        raise ValueError(f"{base} lacks the columns {sorted(missing)}")
    return union_tables(*frames, declared=[*FEED, *schema.names, *([bad_rows] if bad_rows else [])])


class Checked(NamedTuple):
    tables: dict[str, DataFrame]
    errors: DataFrame


def read_checked(
    spark: SparkSession, root: str, folders: dict[str, Sequence[str]] | None = None, **options
) -> Checked:
    """The tables of the feeds that can be read whole, and one error row per table of the others.

    Errors have the feed, the table, the number of rows whose fields don't fit the header, and the
    least of them as an example.  Files are parsed once, into the shared folder, as their rows are
    needed several times.  ``folders`` names the folders of each type that are read, in capitals.
    """
    names = ["routes", "trips", "stop_times", "stops"]
    present = path_exists(spark, table_root(root, "shapes")) if folders is None else bool(folders.get("SHAPES"))
    if present:
        names.append("shapes")
    staged, errors = {}, []
    for name in names:
        rows = read_table(spark, root, name, bad_rows="bad_row", folders=None if folders is None else folders[name.upper()], **options)
        path = shared_dir(spark, f"staged-{name}")
        rows.write.parquet(path)
        staged[name] = spark.read.schema(rows.schema).parquet(path)
        bad = staged[name].where(F.col("bad_row").isNotNull())
        errors.append(bad.groupBy(*FEED).agg(F.lit(name).alias("table"), F.count("*").alias("n_rows"), F.min("bad_row").alias("example")))
    found = reduce(DataFrame.unionByName, errors)
    broken = found.select(*FEED).distinct()
    tables = {name: anti_filter(rows.where(F.col("bad_row").isNull()).drop("bad_row"), broken, FEED) for name, rows in staged.items()}
    return Checked(tables, found)


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    schema = T.StructType([*_all_text(FEED).fields, *SOURCES[name].fields])
    return spark.createDataFrame([], schema)


def read_optional(spark: SparkSession, root: str, name: str, **options) -> tuple[DataFrame, bool]:
    """A table that may be absent: then an empty one of the known schema, and False."""
    if not path_exists(spark, table_root(root, name)):
        return empty_table(spark, name), False
    return read_table(spark, root, name, **options), True


def read_feeds(spark: SparkSession, root: str, **options) -> dict[str, DataFrame]:
    """The source tables of all feeds; shapes only where there are any."""
    names = ("routes", "trips", "stop_times", "stops")
    tables = {name: read_table(spark, root, name, **options) for name in names}
    shapes, has_shapes = read_optional(spark, root, "shapes", **options)
    return {**tables, "shapes": shapes} if has_shapes else tables


def of_feed(df: DataFrame, explotation: str, contract: str, version: str) -> DataFrame:
    """Rows of one feed; on storage only its folder is read."""
    for name, value in zip(FEED, (explotation, contract, version)):
        df = df.where(F.col(name) == value)
    return df


def of_feeds(df: DataFrame, feeds: DataFrame) -> DataFrame:
    """Rows of the feeds of a frame; on storage only their folders are read, which Spark finds out at
    run time from the frame."""
    return pruned_by(df, feeds.select(*FEED), FEED)


def pruned_by(df: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows whose folder columns ``names`` are among ``keys``.

    Up to ``FEW_KEYS`` keys are broadcast, and Spark then reads their folders only: a folder name
    has 255 bytes at most, so that is bounded.  More keys go through a shuffle.
    """
    # Spark prunes by a side that is filtered; a row without a full key matches nothing.
    known = keys.select(*names).where(" AND ".join(f"length({name}) > 0" for name in names)).distinct()
    few = known.limit(FEW_KEYS + 1).count() <= FEW_KEYS
    return df.join(F.broadcast(known) if few else known, list(names), "left_semi")


def write_feed_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    rows_per_file: int = 5_000_000,
    mode: str = "overwrite",
    whole: bool = False,
    n_feeds: int | None = None,
) -> None:
    """Write a table in feed folders.

    Rows are brought together by feed, so small feeds get one file each, and Spark splits the
    feeds that are too large for one task.  Where there are known to be few, ``n_feeds`` of them,
    that shuffle is left out: each task writes its rows as they come to one file per feed.  Only the
    written feeds are replaced, with ``whole`` the whole table.
    """
    few = n_feeds is not None and n_feeds <= OPEN_FEEDS
    writer = (
        (df if few else df.hint("rebalance", *[F.col(name) for name in FEED]))
        .write.mode(mode)
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*FEED)
    )
    if fmt == "csv":
        # Ids are kept as they are, outer space included.
        writer = (
            writer.option("header", "true")
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
        )
    writer.format(fmt).save(path)
