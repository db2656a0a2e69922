"""A content-addressed web archive: payloads once by digest, record headers apart, records by join."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.llm.shared import written

END = "\r\n"
#: Payloads of fewer bytes are never written as revisits.
SMALL = 100
#: WARC-Date of pages whose table has no time of capture.
DATE = "1970-01-01T00:00:00Z"


def payload_of(html: Column) -> Column:
    """UTF-8 bytes of a text, none for null."""
    return F.encode(F.coalesce(html.cast("string"), F.lit("")), "UTF-8")


def record_headers(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", small: int = SMALL, date: str = DATE) -> DataFrame:
    """One row per page: page_id, payload digest, whether it is a revisit, whether its payload is
    small, and the exact header of its WARC record.

    Of the pages with equal payloads of at least ``small`` bytes, that with the smallest id is the
    response; the others are revisits that name it.  A page without an id comes after all others.
    """
    payload = payload_of(F.col(html_col))
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).cast("bigint").alias("bytes"),
    )
    # The hottest payload is one row per task in the grouping.  Its digest is spelled anew, so the
    # join shuffles both sides and Spark splits a digest that many pages share.
    first = rows.where(F.col("bytes") >= small).groupBy("digest").agg(F.min("page_id").alias("first"))
    first = first.withColumn("digest", F.concat("digest", F.lit("")))
    rows = rows.join(first, "digest", "left")
    revisit = (F.col("bytes") >= small) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    record_id = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    flat_url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    header = F.concat(
        F.lit(f"WARC/1.1{END}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", record_id(F.col("first"))))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
        line("WARC-Target-URI", flat_url),
        F.lit(END),
    )
    return rows.select("page_id", "digest", revisit.alias("revisit"), (F.col("bytes") < small).alias("small"), header.alias("header"))


def payloads(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Each distinct payload once: (digest, payload).  Copies within a task meet before the shuffle."""
    payload = payload_of(F.col(html_col))
    rows = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload"))
    return rows.groupBy("digest").agg(F.first("payload").alias("payload"))


def _new_table() -> str:
    return f"archive_{uuid.uuid4().hex}"


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    small: int = SMALL,
    buckets: int | None = None,
    date: str = DATE,
) -> None:
    """Write the archive of ``pages``: ``<folder>/headers`` and ``<folder>/payloads``.

    With ``buckets`` the payloads are dealt into that many buckets by digest; they are shuffled for
    writing only, and a reader that is given the same number takes them from where they lie.

    All records get the ``date``, as a table of pages has none.

    Null html is the empty payload, null url an empty one, line breaks in a url become spaces.
    Repeated rows are records of their own with the same header.  Other columns are ignored.
    """
    record_headers(pages, id_col, url_col, html_col, small, date).write.parquet(f"{folder}/headers")
    store = payloads(pages, html_col).write.format("parquet")
    if buckets is None:
        store.save(f"{folder}/payloads")
    else:
        table = _new_table()
        store.bucketBy(buckets, "digest").option("path", f"{folder}/payloads").saveAsTable(table)
        pages.sparkSession.sql(f"DROP TABLE {table}")  # of an external table, only the name


def _stored(spark: SparkSession, folder: str, buckets: int | None) -> DataFrame:
    """The payloads, each held against its digest again."""
    path = f"{folder}/payloads"
    if buckets is None:
        store = spark.read.schema("digest string, payload binary").parquet(path)
    else:
        table = _new_table()
        spark.sql(f"CREATE TABLE {table} (digest STRING, payload BINARY) USING parquet CLUSTERED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
        store = spark.table(table)
    true = F.sha2("payload", 256) == F.col("digest")
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))
    return store.select("digest", F.when(true, F.col("payload")).otherwise(damaged).alias("payload"))


def _headers(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("page_id bigint, digest string, revisit boolean, small boolean, header string").parquet(f"{folder}/headers")


def _with_payload(headers: DataFrame, store: DataFrame) -> DataFrame:
    lacking = F.raise_error(F.concat(F.lit("no payload "), F.col("digest")))
    found = headers.join(store, "digest", "left")
    return found.withColumn("payload", F.when(F.col("payload").isNotNull(), F.col("payload")).otherwise(lacking))


def _record(body: Column) -> Column:
    return F.concat(F.encode("header", "UTF-8"), body, F.lit((END * 2).encode()))


def read_records(spark: SparkSession, folder: str, buckets: int | None = None, small: int = SMALL) -> DataFrame:
    """Every record of an archive: page_id, digest, header and record (the exact WARC bytes).

    The digest of each stored payload is computed again; the job fails where it is another, or
    where the header of a response names a payload that the archive lacks.  A revisit's own bytes
    hold the header alone.

    A payload of ``small`` bytes or more has one response, so the join with the buckets is one to
    one.  Smaller ones may have any number; they go through a join that Spark can split.
    """
    headers, store = _headers(spark, folder), _stored(spark, folder, buckets)
    little = store.where(F.octet_length("payload") < small).withColumn("digest", F.concat("digest", F.lit("")))
    responses = headers.where(~F.col("revisit"))
    whole = _with_payload(responses.where(~F.col("small")), store).unionByName(_with_payload(responses.where("small"), little))
    revisits = headers.where("revisit").withColumn("payload", F.lit(b""))
    return whole.unionByName(revisits).select("page_id", "digest", "header", _record(F.col("payload")).alias("record"))


def read_archive(spark: SparkSession, folder: str, buckets: int | None = None) -> DataFrame:
    """Every record of an archive with its payload: page_id, header, payload and record.

    As ``read_records``, but a revisit has the payload of the record it refers to.
    """
    found = _with_payload(_headers(spark, folder), _stored(spark, folder, buckets))
    own = F.when(F.col("revisit"), F.lit(b"")).otherwise(F.col("payload"))
    return found.select("page_id", "digest", "header", "payload", _record(own).alias("record"))


def header_field(name: str) -> Column:
    """The value of a field in ``header``, empty where there is none."""
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)", 1)


def parsed_records(records: DataFrame) -> DataFrame:
    """What the bytes of each record say: page_id, header fields, and size and digest of its body.

    The header ends at the first empty line; the body has as many bytes as Content-Length says,
    and two line ends follow it.  A record of any other form fails the job, and so does a response
    whose body has another digest than its header names.
    """
    head = F.substring_index(F.col("record").cast("string"), END * 2, 1)
    rows = records.select("page_id", "record", F.concat(head, F.lit(END * 2)).alias("header"))
    rows = rows.select(
        "page_id",
        "record",
        (F.octet_length("header") + 1).alias("begin"),
        header_field("Content-Length").cast("int").alias("length"),
        header_field("WARC-Type").alias("record_type"),
        F.regexp_extract("header", r"\r\nWARC-Payload-Digest: sha256:([0-9a-f]+)", 1).alias("payload_digest"),
        F.regexp_extract("header", r"\r\nWARC-Refers-To: <urn:page:(-?\d+)>", 1).alias("refers"),
    )
    body = F.col("record").substr(F.col("begin"), F.col("length"))
    sound = F.octet_length("record") == F.col("begin") - 1 + F.col("length") + 4
    sound &= (F.col("record_type") == "revisit") | (F.sha2(body, 256) == F.col("payload_digest"))
    digest = F.when(sound, F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("unsound record "), F.col("payload_digest"))))
    return rows.select(
        "page_id",
        F.col("length").cast("bigint").alias("length"),
        digest.alias("payload_digest"),
        "record_type",
        F.when(F.col("refers") != "", F.col("refers").cast("bigint")).alias("refers_to"),
    )


def record_table(records: DataFrame) -> DataFrame:
    """Per record: page_id, size and digest of the whole payload, type, and the page referred to.

    All of it is parsed from the records, once, and what they say is written.  The size of a
    revisit's payload is that of the response with the same digest.
    """
    parsed = written(parsed_records(records), "records")
    responses, revisits = (parsed.where(F.col("record_type") == kind) for kind in ("response", "revisit"))
    sizes = responses.groupBy("payload_digest").agg(F.max("length").alias("payload_bytes"))
    sizes = sizes.withColumn("payload_digest", F.concat("payload_digest", F.lit("")))
    seen = revisits.join(sizes, "payload_digest", "left")
    return responses.withColumnRenamed("length", "payload_bytes").unionByName(seen.drop("length")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
