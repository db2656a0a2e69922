"""Hard negatives from a vector table: exact integer scores by products modulo small primes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.llm.shared import written

#: Moduli.  Residues lie within 125 of zero, so 1,024 products add up to less than 2**24 and float32 is exact.
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
PART = 1024
#: Scores beyond this can't be compared by percent in 64 bits.
LARGEST = 2.0 ** 56
#: Components of a cell's rows and of its anchors, at most; a task holds one cell.
CELL, ANCHORS = 1 << 22, 1 << 21
#: Rows and anchors of a tile, whose scores are in memory at once.
TILE_ROWS, TILE_ANCHORS = 4096, 256
_LEAST = np.iinfo(np.int64).min
_KINDS = {2: "<i2", 4: "<i4", 8: "<f8"}


def _near(x: np.ndarray, p: int) -> np.ndarray:
    """The number next to zero that is ``x`` modulo ``p``; of larger ``x``, one close to it."""
    return x - np.float32(p) * np.rint(x * np.float32(1 / p))


def residues(q: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """The whole numbers ``q`` (float64) modulo each prime, next to zero, as float32."""
    return [_near(np.fmod(q, p).astype(np.float32), p) for p in primes]


def primes_for(bound: float) -> tuple[int, ...]:
    """The fewest moduli whose product tells all whole numbers within ``bound`` of zero apart."""
    product = 1
    for n, p in enumerate(PRIMES, 1):
        product *= p
        if product > 2 * bound + 2:
            return PRIMES[:n]
    raise ValueError(f"scores up to {bound:g} are beyond the {PRIMES} residues")


def products(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``, given by residues: a float32 matrix product per
    prime, then the signed number by Chinese remaindering in mixed radix, digits next to zero."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        rest = np.zeros((len(a[i]), len(b[i])), np.float32)
        for at in range(0, a[i].shape[1], PART):
            rest += _near(a[i][:, at : at + PART] @ b[i][:, at : at + PART].T, p)
            rest = _near(rest, p)
        for digit, earlier in zip(digits, primes):
            rest = _near(_near(rest - digit, p) * np.float32(_small(pow(earlier, -1, p), p)), p)
        digits.append(rest)
    out = digits[-1].astype(np.int64)
    for digit, p in zip(digits[-2::-1], primes[-2::-1]):
        out *= p
        out += digit.astype(np.int64)
    return out


def _small(x: int, p: int) -> int:
    return x - p if x > p // 2 else x


def first_of_each(scores: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row by row the column of the largest score, the leftmost among equals, then of the next; spoils ``scores``."""
    rows = np.arange(len(scores))
    for _ in range(min(n, scores.shape[1])):
        best = scores.argmax(1)
        value = scores[rows, best]
        scores[rows, best] = _LEAST
        yield best, value


class Vectors:
    """The vectors of one side of a cell, by label and id."""

    def __init__(self, table: pa.Table, order: tuple[str, ...]):
        table = table.sort_by([(c, "ascending") for c in order])
        self.table, self.n = table, len(table)
        self.id, self.label = (table.column(c).to_numpy() for c in ("id", "label"))
        packed, kinds = table.column("q").to_pylist(), table.column("kind").to_pylist()
        self.q = np.zeros((self.n, max((len(x) // k for x, k in zip(packed, kinds)), default=0)))
        for i, (x, kind) in enumerate(zip(packed, kinds)):
            self.q[i, : len(x) // kind] = np.frombuffer(x, _KINDS[kind])
        self.norm = math.sqrt(table.column("square").to_numpy().max(initial=0.0))

    def prepare(self, width: int, primes: tuple[int, ...]) -> None:
        wide = np.pad(self.q, ((0, 0), (0, width - self.q.shape[1])))
        self.parts = residues(wide, primes)

    def part(self, begin: int, end: int) -> list[np.ndarray]:
        return [x[begin:end] for x in self.parts]

    def labels(self) -> Iterator[tuple[int, int, int]]:
        """Each label with the bounds of its rows."""
        bounds = np.flatnonzero(np.concatenate([[True], self.label[1:] != self.label[:-1], [True]])) if self.n else []
        for begin, end in zip(bounds[:-1], bounds[1:]):
            yield int(self.label[begin]), int(begin), int(end)


def _sides(rows: pa.Table, anchors: pa.Table) -> tuple[Vectors, Vectors, tuple[int, ...]]:
    r, a = Vectors(rows, ("label", "id")), Vectors(anchors, ("label", "id", "anchor"))
    primes = primes_for(1.001 * r.norm * a.norm)
    width = max(r.q.shape[1], a.q.shape[1])
    for side in (r, a):
        side.prepare(width, primes)
    return r, a, primes


def _cell_positives(most: int):
    fields = ("anchor", "id", "score")

    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in fields]
        if len(rows) and len(anchors):
            r, a, primes = _sides(rows, anchors)
            key = a.table.column("anchor").to_numpy()
            of_label = {label: (x, y) for label, x, y in r.labels()}
            for label, begin, end in a.labels():
                x, y = of_label.get(label, (0, 0))
                for i in range(begin, end, TILE_ANCHORS):
                    i_end = min(i + TILE_ANCHORS, end)
                    for j in range(x, y, TILE_ROWS):
                        j_end = min(j + TILE_ROWS, y)
                        scores = products(a.part(i, i_end), r.part(j, j_end), primes)
                        scores[a.id[i:i_end, None] == r.id[None, j:j_end]] = _LEAST
                        for best, value in first_of_each(scores, most):
                            found = value != _LEAST
                            for column, values in zip(out, (key[i:i_end], r.id[j + best], value)):
                                column.append(values[found])
        return pa.table([np.concatenate(c) for c in out], names=list(fields))

    return work


def _cell_negatives(most: int, low: int, high: int):
    fields = ("anchor", "nth", "id", "score")

    def work(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in fields]
        if len(rows) and len(anchors):
            r, a, primes = _sides(rows, anchors)
            key, positives = a.table.column("anchor").to_numpy(), a.table.column("positives").to_pylist()
            of_label = {label: (x, y) for label, x, y in r.labels()}
            wide = max(map(len, positives))
            # Without a positive the range is empty.
            ceiling, floor = np.full((a.n, wide), _LEAST), np.zeros((a.n, wide), np.int64)
            for i, scores in enumerate(positives):
                for k, score in enumerate(scores):
                    if score >= 0:  # below zero no score is within the range
                        ceiling[i, k], floor[i, k] = high * score // 100, -(-low * score // 100)
            for label, begin, end in a.labels():
                x, y = of_label.get(label, (0, 0))
                for i in range(begin, end, TILE_ANCHORS):
                    i_end = min(i + TILE_ANCHORS, end)
                    for j in range(0, r.n, TILE_ROWS):
                        j_end = min(j + TILE_ROWS, r.n)
                        if x <= j and j_end <= y:
                            continue
                        scores = products(a.part(i, i_end), r.part(j, j_end), primes)
                        scores[:, max(x - j, 0) : max(y - j, 0)] = _LEAST
                        # Rows of a tile are by label; among equal scores the smallest id comes first.
                        by_id = np.argsort(r.id[j:j_end], kind="stable")
                        scores = scores[:, by_id]
                        for k in range(wide):
                            top, least = ceiling[i:i_end, k], floor[i:i_end, k]
                            for best, value in first_of_each(np.where(scores <= top[:, None], scores, _LEAST), most):
                                found = (value != _LEAST) & (value >= least)
                                if not found.any():
                                    break
                                for column, values in zip(out, (key[i:i_end], np.full(i_end - i, k), r.id[j + by_id[best]], value)):
                                    column.append(values[found])
        return pa.table([np.concatenate(c) for c in out], names=list(fields))

    return work


def _packed(scale: int):
    """Rows as whole numbers floor(scale * x) in the fewest bytes that hold them, with the sum of their squares."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, kinds, squares = [], [], []
            vectors = batch.column(2)
            flat, bounds = vectors.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
            with np.errstate(over="ignore"):
                whole = np.floor(flat.astype(np.float64) * scale)
            for begin, end in zip(bounds[:-1], bounds[1:]):
                q = whole[begin:end]
                largest = np.abs(q).max(initial=0.0)
                kind = 2 if largest < 1 << 15 else 4 if largest < 1 << 31 else 8
                packed.append(q.astype(_KINDS[kind]).tobytes())
                kinds.append(kind)
                with np.errstate(over="ignore"):
                    squares.append(float(q @ q))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), pa.array(kinds, pa.int32()), pa.array(squares, pa.float64())],
                names=["id", "label", "q", "kind", "square"],
            )

    return work


def hard_negatives(
    vectors: DataFrame, is_anchor: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
    cell: int = CELL, anchor_cell: int = ANCHORS,
) -> DataFrame:
    """For each anchor and each of its positives the best-scored rows of other labels that aren't too close.

    A component x counts as floor(scale * x), and a score is the exact inner product of those.  An
    anchor's positives are the ``positives`` rows of its label with the highest scores, rows of its
    own id left out; a positive's negatives are the first ``negatives`` rows of other labels with
    low % to high % of the positive's score.  Ties go by smaller id.  Returns anchor_id, positive_id,
    rank (from 1), negative_id, positive_score and negative_score.  Anchors are the rows where
    ``is_anchor`` holds, by default those whose id is divisible by 50.

    Anchors meet all rows in cells of bounded size, dealt out evenly whatever the labels and ids:
    rows are copied once for every ``anchor_cell`` components of anchors, anchors once for every
    ``cell`` components of rows.  Only the best few of a cell leave it.

    Rows with a null id, label or vector, or any null or non-finite component take no part.  A
    shorter vector counts as if zeros followed; an empty one scores 0.  Repeated rows count each, as
    anchors too, and may be each other's negatives only under different labels.  Scores that 64 bits
    can't hold with their percentages (2**56) end the job with an error.  Other columns are ignored.
    """
    is_anchor = F.col(id_col) % 50 == 0 if is_anchor is None else is_anchor
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ~F.exists(vector_col, bad))
    fields = "id bigint, label bigint, q binary, kind int, square double"
    plain = lambda df: df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).alias("v"))
    packed = written(plain(rows).mapInArrow(_packed(scale), fields), "vectors")
    keyed = plain(rows.where(is_anchor)).mapInArrow(_packed(scale), fields)
    anchors = written(keyed.withColumn("anchor", F.monotonically_increasing_id()), "anchors")

    size = lambda df: df.agg(F.count("*"), F.max(F.length("q") / F.col("kind")), F.max("square")).first()
    (n, width, square), (m, _, anchor_square) = size(packed), size(anchors)
    if n and m and not 1.001 * math.sqrt(square) * math.sqrt(anchor_square) < LARGEST:
        raise ValueError("the largest vectors' inner product may be beyond 2**56")
    width = max(int(width or 0), 1)
    # At most so many components to a cell; small tables still make some dozens.
    g = math.ceil(n / max(min(cell // width, max(n // 64, 2048)), 1)) or 1
    h = math.ceil(m / max(anchor_cell // width, 1)) or 1
    # By place and not by id, so that no id, label or vector gathers rows in a cell.
    deal = lambda df, k: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(k)).cast("int")
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = packed.withColumn("g", deal(packed, g)).withColumn("h", each(h)).groupBy("g", "h")
    cells = lambda df: left.cogroup(df.withColumn("h", F.pmod(F.xxhash64("anchor"), F.lit(h)).cast("int")).withColumn("g", each(g)).groupBy("g", "h"))

    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    found = cells(anchors).applyInArrow(_cell_positives(positives), "anchor bigint, id bigint, score bigint")
    found = written(found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= positives), "positives")

    # At most ``positives`` scores to an anchor, by their place.
    scores = found.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "score"))), lambda x: x["score"]).alias("positives"))
    chosen = cells(anchors.join(scores, "anchor")).applyInArrow(_cell_negatives(negatives, low, high), "anchor bigint, nth bigint, id bigint, score bigint")
    best = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id")
    chosen = chosen.withColumn("nth", (F.col("nth") + 1).cast("int")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return (
        chosen.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        .join(found.withColumnsRenamed({"id": "positive_id", "score": "positive_score"}), ["anchor", "nth"])
        .join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )
