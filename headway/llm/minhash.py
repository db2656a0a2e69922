"""Near-duplicate documents by circulant MinHash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from headway.llm.shared import components, written
from headway.llm.words import U64, bounded, mix64, shingles, text_column, word_codes

U32 = np.uint32
#: Shingles hashed together; they stay in a core's cache while all coordinates are made.
BLOCK = 1 << 15
#: Members of a block of a bucket in the second round.
MEMBERS = 1000


def circulant_signatures(codes: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """MinHash signatures (rows x k, 32 bits) of rows of shingle codes from two permutations.

    The first permutation places a shingle on a circle of 2^32 slots.  The second is turned by one
    slot for each coordinate, so coordinate j is the least of pi(sigma(s) + j) over the row.  Every
    row must have a shingle.
    """
    placed = (mix64(codes ^ U64(0x5851F42D4C957F2D)) >> U64(32)).astype(U32)
    out = np.full((len(bounds) - 1, k), 0xFFFFFFFF, U32)
    row = 0
    while row < len(bounds) - 1:
        last = max(row + 1, int(np.searchsorted(bounds, bounds[row] + BLOCK, "right")) - 1)
        for at in range(int(bounds[row]), int(bounds[last]), BLOCK):  # a long row takes several blocks
            end = min(at + BLOCK, int(bounds[last]))
            starts = np.maximum(bounds[row:last] - at, 0) if last - row > 1 else np.zeros(1, np.int64)
            here, v, t = placed[at:end], np.empty(end - at, U32), np.empty(end - at, U32)
            for j in range(k):
                np.add(here, U32(j), out=v)
                np.right_shift(v, U32(16), out=t)
                np.bitwise_xor(v, t, out=v)
                np.multiply(v, U32(0x7FEB352D), out=v)
                np.right_shift(v, U32(15), out=t)
                np.bitwise_xor(v, t, out=v)
                np.multiply(v, U32(0x846CA68B), out=v)
                np.right_shift(v, U32(16), out=t)
                np.bitwise_xor(v, t, out=v)
                np.minimum(out[row:last, j], np.minimum.reduceat(v, starts), out=out[row:last, j])
        row = last
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates; the same rows in another band differ."""
    n, k = signatures.shape
    cells = signatures.reshape(n, k // rows, rows).astype(U64)
    key = np.broadcast_to(np.arange(1, k // rows + 1, dtype=U64), cells.shape[:2]).copy()
    for j in range(rows):
        key = mix64(key * U64(0xD1342543DE82EF95) + cells[:, :, j])
    return key.view(np.int64)


def _rows(values: np.ndarray) -> pa.Array:
    width = values.shape[1]
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * width), pa.array(values.ravel()))


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, k: int, rows: int) -> DataFrame:
    """Per row: id, size and digest of its shingle set, and its band keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            codes, bounds = shingles(*word_codes(text_column(batch, "text")), width)
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            digests: list[bytes | None] = [None] * len(sizes)
            counts = np.zeros(len(sizes), np.int64)
            for i in full:
                own = np.unique(codes[bounds[i] : bounds[i + 1]])
                counts[i] = len(own)
                digests[i] = xxhash.xxh3_128_digest(own.tobytes())
            signatures = np.zeros((len(sizes), k), U32)
            if len(full):
                packed = np.concatenate([[0], np.cumsum(sizes[full])])
                signatures[full] = circulant_signatures(codes, packed, k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(digests, pa.binary()), _rows(band_keys(signatures, rows))],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        work, "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>"
    )


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """The whole shingle set of each row of (doc_id, text) with a word, as codes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            codes, bounds = shingles(*word_codes(text_column(batch, "text")), width)
            for i in range(0, len(batch), 64):
                part = [np.unique(codes[bounds[j] : bounds[j + 1]]).view(np.int64) for j in range(i, min(i + 64, len(batch)))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 64), pa.array(part, pa.list_(pa.int64()))], names=["doc_id", "codes"])

    return docs.mapInArrow(work, "doc_id bigint, codes array<bigint>").where(F.size("codes") > 0)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("codes").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("codes").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    sized = F.least(F.size("x"), F.size("y")) * 100 >= F.greatest(F.size("x"), F.size("y")) * percent
    joined = pairs.join(left, "a").join(right, "b").where(sized).select("a", "b", "x", "y", shared.alias("both"))
    return joined.where(F.col("both") * 100 >= (F.size("x") + F.size("y") - F.col("both")) * percent).select("a", "b")


def _across(percent: int):
    """Links of a block of a bucket's probes to a block of its members under other labels, on full sets.

    Each probe's shingles are looked up in an index of the block, which counts what it shares with
    every member at once.  One link per probe and label is enough to join the groups.
    """

    def work(table: pa.Table) -> pa.Table:
        ids, label, probe, here = (np.array(table.column(c)) for c in ("doc_id", "label", "probe", "here"))
        sets = table.column("codes").combine_chunks()
        codes, ends = np.array(sets.flatten()), np.array(sets.offsets)
        ends = ends - ends[0]
        size = np.diff(ends)
        owner = np.repeat(np.arange(len(ids)), size)
        inside = here[owner]
        order = np.argsort(codes[inside], kind="stable")
        posted, members = codes[inside][order], owner[inside][order]
        found = []
        for i in np.flatnonzero(probe):
            own = codes[ends[i] : ends[i + 1]]
            low, high = np.searchsorted(posted, own), np.searchsorted(posted, own, "right")
            spans = [members[x:y] for x, y in zip(low, high) if y > x]
            if spans:
                both = np.bincount(np.concatenate(spans), minlength=len(ids))
                near = np.flatnonzero((both * 100 >= (size + size[i] - both) * percent) & here & (label != label[i]) & (both > 0))
                found += {label[j]: (ids[i], ids[j]) for j in near}.values()
        return pa.table({"a": pa.array([max(x) for x in found], pa.int64()), "b": pa.array([min(x) for x in found], pa.int64())})

    return work


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 75,
    bands: int = 32,
    rows: int = 4,
) -> DataFrame:
    """Groups of documents whose sets of word shingles are alike: one row per input row.

    Returns doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept.
    Documents are linked when 100 * common shingles >= ``percent`` * all shingles of the two.

    1. Equal sets become one class, so copies cost no comparison.
    2. Circulant signatures are cut into bands; classes that share a band meet in a bucket.  Each
       class is first held against the smallest id of its buckets only, on the full sets.
    3. In buckets that still hold several groups, every class outside the largest one is held against
       all of the bucket on the full sets, in blocks of bounded size; pairs are counted in an index
       of the block and only links come out.  A bucket that hangs together costs nothing here.
    4. Links become groups by joins alone.

    With 32 bands of 4 a pair exactly at the threshold is missed with probability 5e-6.  A word
    is a run of characters other than ASCII white space, A-Z in lower case.  Null, empty and blank
    texts have no shingles and link with nothing.  Rows with the same doc_id are one document,
    linked if any of its texts is.  A row without doc_id has component_id null and is kept.  Other
    columns are ignored.
    """
    spark, k = docs.sparkSession, bands * rows
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketch = written(sketches(plain, "doc_id", "text", width, k, rows), "sketches")

    # Written, so that the join below is dealt out anew and Spark can split a hot digest there.
    classes = written(sketch.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep")).where("rep is not null"), "digests")
    member = sketch.where("doc_id is not null").join(classes, "digest")
    copies = member.where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    one = written(member.where("doc_id = rep").select("doc_id", "bands"), "classes")
    bucket = one.select("doc_id", F.explode("bands").alias("key"))
    shared = bucket.groupBy("key").agg(F.min("doc_id").alias("leader"), F.count("*").alias("members")).where("members > 1")
    in_shared = written(bucket.join(shared, "key"), "buckets")

    pairs = written(in_shared.where("doc_id != leader").select(F.col("doc_id").alias("a"), F.col("leader").alias("b")).distinct(), "pairs")
    needed = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct()
    # The same plan at every size: the ids grow with the documents, so they are not broadcast.
    sets = written(shingle_sets(plain.join(needed.hint("merge"), "doc_id", "left_semi"), width), "sets")
    near = written(_verified(pairs, sets, percent), "near")

    label = components(near)
    known = in_shared.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", "members", F.coalesce("label", "doc_id").alias("label"))
    known = written(known, "labels")
    share = known.groupBy("key", "label").agg(F.count("*").alias("n"))
    mixed = share.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("top"), (F.sum("n") - F.max("n")).alias("probes")).where("probes > 0")
    # A link between labels has an end outside the commonest one: only those ends are probes.
    # Probes are dealt into blocks too, so a group holds a block of either, whatever the bucket.
    blocks, probing = F.ceil(F.col("members") / MEMBERS), F.ceil(F.col("probes") / MEMBERS)
    rows_of = known.join(mixed, "key").withColumn("home", F.pmod(F.xxhash64("doc_id"), blocks)).withColumn("turn", F.pmod(F.xxhash64("doc_id", F.lit(1)), probing))
    rows_of = rows_of.withColumn("outside", F.col("label") != F.col("top"))
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    at = lambda turn, home: F.struct(turn.alias("turn"), home.alias("home"))
    as_member = F.transform(upto(probing), lambda i: at(i, F.col("home")))
    as_probe = F.transform(upto(blocks), lambda i: at(F.col("turn"), i))
    places = F.when(F.col("outside"), F.array_union(as_member, as_probe)).otherwise(as_member)
    probe, here = F.expr("outside and turn = block.turn").alias("probe"), F.expr("home = block.home").alias("here")
    dealt = rows_of.select("*", F.explode(places).alias("block")).select("key", "doc_id", "label", "block", probe, here)
    more = written(dealt.join(sets, "doc_id").groupBy("key", "block").applyInArrow(_across(percent), "a bigint, b bigint").distinct(), "more")

    groups = written(components(copies.unionAll(near).unionAll(more)), "groups")
    found = F.coalesce("label", "doc_id")
    return sketch.select("doc_id", "n_shingles").join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", found.alias("component_id"), F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept")
    )
