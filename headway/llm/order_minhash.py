"""Document fingerprints by Order MinHash: alike where texts are alike by edits, order included."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.shared import written
from headway.llm.words import U64, bounded, mix64, text_column

#: Bytes of a k-mer; it is a 64-bit value as it stands.
K = 8
#: Tuples of a fingerprint, and k-mers of a tuple.
BINS, LENGTH = 64, 2
#: Low bits that hold a position while a hash is sorted; longer texts take the slower way.
AT = 22

_BIN_STARTS = np.arange(BINS + 1, dtype=np.float64) * 2.0 ** 64 / BINS
_STARTS = np.array([int(x) for x in _BIN_STARTS[:-1]], U64) >> U64(AT)


def _in_order(hashes: np.ndarray, at: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The upper bits of the hashes sorted, and their positions in text order among equals."""
    n = len(hashes)
    if n < 1 << AT:
        low = U64((1 << AT) - 1)
        keys = (hashes & ~low) | (np.arange(n, dtype=U64) if at is None else at.astype(U64))
        keys.sort()
        return keys >> U64(AT), (keys & low).astype(np.int64)
    high = hashes >> U64(AT)
    order = np.lexsort((at, high)) if at is not None else np.argsort(high, kind="stable")
    return high[order], order if at is None else at[order]


def fingerprint(text: bytes) -> np.ndarray:
    """A 16-bit value per bin, 0 where the text has no k-mer for it.

    The k-mers that end at each byte are numbered by how often they came before, hashed with that
    number and dealt into bins.  The ``LENGTH`` least of a bin are put back into text order and
    hashed as a tuple.  Before the first byte stand zeros, so short texts have k-mers too.
    """
    out = np.zeros(BINS, np.uint16)
    n = len(text)
    if not n:
        return out
    padded = b"\0" * (K - 1) + text
    grams = np.ascontiguousarray(np.ndarray((n,), "<u8", padded, 0, (1,))).astype(U64, copy=False)
    grams, at = _in_order(mix64(grams), None)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(grams[1:], grams[:-1], out=new[1:])
    first = np.flatnonzero(new)
    if len(first) < n:
        number = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        grams = grams + number.astype(U64) * U64(0x9E3779B97F4A7C15)
    codes, at = _in_order(mix64(grams), at)
    begin = np.searchsorted(codes, _STARTS)
    end = np.append(begin[1:], n)
    full = np.flatnonzero(end > begin)
    begin, end = begin[full], end[full]
    picks = begin[:, None] + np.arange(LENGTH)
    there = picks < end[:, None]
    picks = np.minimum(picks, n - 1)
    where = np.where(there, at[picks], np.iinfo(np.int64).max)
    turn = np.argsort(where, axis=1, kind="stable")
    values = np.take_along_axis(np.where(there, codes[picks], U64(0)), turn, 1)
    total = np.zeros(len(full), U64)
    for j in range(LENGTH):
        total = mix64(total * U64(0xD1342543DE82EF95) + values[:, j] + U64(1))
    out[full] = np.maximum(total >> U64(48), U64(1)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the bins filled in either that agree; two empty fingerprints agree."""
    filled = np.count_nonzero((a != 0) | (b != 0))
    return float(np.count_nonzero((a == b) & (a != 0)) / filled) if filled else 1.0


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_FIELDS = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    edited = edited_text(text, following).encode()
    theirs = fingerprint(edited)
    return (
        len(text), hashlib.sha256(edited).hexdigest(), own.astype(">u2").tobytes().hex(), theirs.astype(">u2").tobytes().hex(),
        likeness(own, theirs), likeness(own, other),
    )


def order_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex), near_edited and
    near_next.  The edited text has its last quarter replaced by the beginning of the next text in
    the order of doc_id (null first, equal ids by text hash); after the last comes the first.  Null
    is the empty text, whose fingerprint is all zeros; two empty texts are alike.  A lone document
    is its own next.  Other columns are ignored.

    The texts are shuffled once, by ranges of the order.  Each task reads its range as a stream and
    keeps one text back; what the ends of the ranges need is passed on in a table with two rows
    per range.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        found: list[tuple] = []

        def flush() -> pa.RecordBatch:
            names = ["doc_id", *[x.split()[0] for x in _FIELDS.split(", ")], "text", "edge"]
            batch = pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in found], schema=schema)
            found.clear()
            return batch

        for batch in bounded(batches, "text"):
            for doc, text in zip(batch.column(0).to_pylist(), text_column(batch, "text").to_pylist()):
                own = fingerprint(text.encode())
                if held is None:
                    found.append((doc, *[None] * 6, text, "first"))
                else:
                    found.append((held[0], *_compared(held[1], held[2], text, own), None, None))
                held = (doc, text, own)
            yield flush()
        if held is not None:
            found.append((held[0], *[None] * 6, held[1], "last"))
            yield flush()

    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(x, pa.string()) for x in ("edited_sha256", "fingerprint", "edited_fingerprint")],
         ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string()), ("edge", pa.string())]
    )
    streamed = rows.select("doc_id", "text").mapInArrow(work, f"doc_id bigint, {_FIELDS}, text string, edge string")
    table = written(streamed.withColumn("range", F.spark_partition_id()), "fingerprints")

    # Range numbers only: as many as there are shuffle partitions.
    ranges = [x[0] for x in table.where("edge = 'first'").select("range").orderBy("range").collect()]
    after = docs.sparkSession.createDataFrame(list(zip(ranges, ranges[1:] + ranges[:1])), "range int, following int")
    last = table.where("edge = 'last'").select("range", "doc_id", "text").join(after, "range")
    first = table.where("edge = 'first'").select(F.col("range").alias("following"), F.col("text").alias("next_text"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, following in zip(*(batch.column(i).to_pylist() for i in range(3))):
                row = (doc, *_compared(text, fingerprint(text.encode()), following, fingerprint(following.encode())))
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema=pa.schema(list(schema)[:7]))

    joined = last.join(first, "following").select("doc_id", "text", "next_text")
    columns = ["doc_id", *[x.split()[0] for x in _FIELDS.split(", ")]]
    return table.where("edge is null").select(*columns).unionByName(joined.mapInArrow(ends, f"doc_id bigint, {_FIELDS}"))
