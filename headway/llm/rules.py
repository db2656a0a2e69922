"""Quality rules: counted base rules, then a calibrated regression on hashed word and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.logistic import Logistic, sigmoid
from headway.llm.shared import written
from headway.llm.words import U64, WHITE, bounded, run_codes, text_bytes, text_column, word_codes

#: n-grams of words and of bytes that are features, and the slots they are hashed to.
WORD_GRAMS, BYTE_GRAMS, SLOTS = (1, 2), (3, 5), 1 << 15
#: Words of a window that counts as repeated, fewest words, highest percentage of repeated words.
REPEAT, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Calibrated chance of good quality from which a document is kept, and from which it is graded high.
KEEP_AT, HIGH_AT = 0.5, 0.9

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of ``flags`` in each row's bounds."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_words(ids: np.ndarray, bounds: np.ndarray, width: int = REPEAT) -> np.ndarray:
    """Words of each row in runs of ``width`` words that occur twice or more in the row.

    ``ids`` number the words; runs are numbered by pairs of runs half as long, so equal numbers are
    equal runs.  ``width`` is a power of two.
    """
    out = np.zeros(len(bounds) - 1, np.int64)
    n = len(ids) - width + 1
    if n <= 0:
        return out
    runs, size = ids.astype(np.int64), 1
    while size < width:
        pairs = runs[:-size] * (int(runs.max()) + 1) + runs[size:]
        runs, size = np.unique(pairs, return_inverse=True)[1].astype(np.int64), size * 2
    row = np.searchsorted(bounds, np.arange(n), "right") - 1
    within = np.flatnonzero(np.arange(n) + width <= bounds[row + 1])
    if not len(within):
        return out
    _, which, often = np.unique(row[within] * (int(runs.max()) + 1) + runs[within], return_inverse=True, return_counts=True)
    again = within[often[which] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    return _sums(np.cumsum(edge[:-1]) > 0, bounds)


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of the base rules for each text."""
    data, bounds = text_bytes(column)
    data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
    number: dict[bytes, int] = {}
    ids: list[int] = []
    ends, dup_lines = [0], []
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        text = data[begin:end].tobytes()
        ids.extend([number.setdefault(word, len(number)) for word in text.split()])  # bytes split at ASCII white space
        ends.append(len(ids))
        lines = [line for line in text.split(b"\n") if line and not line.isspace()]
        dup_lines.append(len(lines) - len(set(lines)))
    at = np.array(ends)
    return {
        "n_words": np.diff(at),
        "word_chars": _sums(~WHITE[data] & ((data & 0xC0) != 0x80), bounds),
        "n_symbols": _sums(_SYMBOL[data], bounds),
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": repeated_words(np.array(ids, np.int64), at),
    }


def grams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind of n-gram the slots of all n-grams and where each text's begin and end."""
    data, bounds = text_bytes(column)
    data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
    shift = U64(64 - SLOTS.bit_length() + 1)
    codes, at = word_codes(column)
    for n in WORD_GRAMS:
        slot = (run_codes(codes, n) >> shift).astype(np.int64)
        yield slot, *_spans(at, n)
    wide = data.astype(U64)
    for n in BYTE_GRAMS:
        size = max(len(wide) - n + 1, 0)
        code = np.full(size, n, U64)
        for j in range(n):
            code = code << U64(8) | wide[j : j + size]
        slot = (code * U64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
        yield slot, *_spans(bounds, n)


def _spans(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    begin = bounds[:-1].astype(np.int64)
    return begin, np.maximum(bounds[1:] - n + 1, begin)


def features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its slots in order and what each holds: the n-gram's share among its kind."""
    rows, slots, shares = [], [], []
    for kind, (slot, begin, end) in enumerate(grams(column)):
        size = end - begin
        row = np.repeat(np.arange(len(column)), size)
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        key, often = np.unique(row * SLOTS + slot[at], return_counts=True)
        rows.append(key // SLOTS)
        slots.append(key % SLOTS + kind * SLOTS)
        shares.append(often / size[rows[-1]])
    row, slot, share = (np.concatenate(x) for x in (rows, slots, shares))
    order = np.argsort(row, kind="stable")
    cut = np.searchsorted(row[order], np.arange(1, len(column)))
    return list(zip(np.split(slot[order], cut), np.split(share[order], cut))) if len(column) else []


class Rules(NamedTuple):
    """Weights of the slots and the model that turns their sum into a chance."""

    weights: np.ndarray
    chance: Logistic

    def score(self, column: pa.Array) -> np.ndarray:
        """Calibrated chance that each text is of good quality: the mean weight of each kind of n-gram, summed."""
        total = np.zeros(len(column))
        for kind, (slot, begin, end) in enumerate(grams(column)):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[kind * SLOTS + slot])])
            # A text too short for a kind may lie behind its last n-gram.
            begin, end = (np.minimum(x, len(slot)) for x in (begin, end))
            total += (sums[end] - sums[begin]) / np.maximum(end - begin, 1)
        return self.chance.score(total[:, None])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray, kept_back: np.ndarray, steps: int = 80, rate: float = 4.0, ridge: float = 1e-6) -> Rules:
    """Weights from the rows not kept back, by full gradients with a step size per slot; calibration from the others.

    Without rows of both classes every score is their share of good ones, or 0.5 without rows.
    """
    width = (len(WORD_GRAMS) + len(BYTE_GRAMS)) * SLOTS
    use = np.flatnonzero(~kept_back)
    weights, bias = np.zeros(width), 0.0
    target, mass = y[use], weight[use]
    if len(use) and 0 < target.sum() < len(use):
        size = np.array([len(rows[i][0]) for i in use])
        slot = np.concatenate([rows[i][0] for i in use])
        share = np.concatenate([rows[i][1] for i in use])
        owner = np.repeat(np.arange(len(use)), size)
        # Both classes weigh alike, so that the rare one is learned as well.
        mass = np.where(target > 0, mass / mass[target > 0].sum(), mass / mass[target == 0].sum()) / 2
        seen, seen_bias = np.full(width, 1e-8), 1e-8
        for _ in range(steps):
            sums = np.bincount(owner, weights[slot] * share, len(use)) + bias
            miss = mass * (sigmoid(sums) - target)
            gradient = np.bincount(slot, miss[owner] * share, width) + ridge * weights
            seen += gradient * gradient
            weights -= rate * gradient / np.sqrt(seen)
            seen_bias += miss.sum() ** 2
            bias -= 0.1 * miss.sum() / np.sqrt(seen_bias)
    score = lambda i: float(weights[rows[i][0]] @ rows[i][1])
    back = np.flatnonzero(kept_back) if 0 < y[kept_back].sum() < kept_back.sum() else np.arange(len(y))
    return Rules(weights, Logistic(0.01).fit(np.array([[score(i)] for i in back]).reshape(-1, 1), y[back], weight[back]))


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _fold(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(-1))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 1500) -> Rules:
    """The model from at most ``sample`` labelled documents of each class, those with the smallest hashes.

    Documents whose crc32(doc_id as text) mod 5 is 0 are held out, those with remainder 1 calibrate.
    A document with both labels, or with several texts, teaches nothing.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(_fold(F.col("doc_id")) > 0).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other")
    known = written(known, "labelled")
    total = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    chosen = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for q in (0, 1)]
    # A document with many rows shrinks to one before the shuffle; then the rows are bounded by the sample.
    rows = _plain(docs, id_col, text_col).join(F.broadcast(written(chosen[0].unionAll(chosen[1]), "sample")), "doc_id").withColumn("fold", _fold(F.col("doc_id")).cast("int"))
    single = rows.groupBy("doc_id").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("text", "quality", "fold")]).where("n = 1").drop("n")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            found = features(text_column(batch, "text"))
            slots = pa.array([s.astype(np.int32).tobytes() for s, _ in found], pa.binary())
            shares = pa.array([x.astype(np.float32).tobytes() for _, x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), slots, shares], names=["doc_id", "quality", "fold", "slots", "shares"])

    found = sorted(single.mapInArrow(work, "doc_id bigint, quality int, fold int, slots binary, shares binary").collect(), key=lambda r: r["doc_id"])
    pairs = [(np.frombuffer(r["slots"], np.int32), np.frombuffer(r["shares"], np.float32).astype(float)) for r in found]
    y = np.array([r["quality"] for r in found], float)
    # A class of which a part was chosen counts for all of it.
    weight = np.array([total[r["quality"]] / min(total[r["quality"]], sample) for r in found], float)
    return fit(pairs, y, weight, np.array([r["fold"] == 1 for r in found], bool))


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 1500, keep_at: float = KEEP_AT, high_at: float = HIGH_AT) -> DataFrame:
    """Rule counts, base verdict, score and verdict of every whole text.

    Words are runs of signs other than ASCII white space, compared as they are.  Returns doc_id,
    n_words, word_chars (code points in words), n_symbols (``#*$%&|<>``), n_dup_lines (lines with a
    word that equal an earlier line), n_repeat_words (words in 8-word runs found twice or more),
    base_failed (under 20 words, or over 30 % of them repeated), score (calibrated chance of good
    quality), grade (rule, low, fair or high), kept (no base rule failed and score >= ``keep_at``)
    and held_out.  Null text is empty and fails; a null doc_id is not held out; repeated rows are
    judged each.  Without labels of both kinds every score is the share of good ones, or 0.5.
    Other columns are ignored.
    """
    model = learn(docs, labels, id_col, text_col, sample)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text", 1 << 20):
            column = text_column(batch, "text")
            found = base_counts(column)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(found[c], pa.int64()) for c in counts], pa.array(model.score(column))], names=["doc_id", *counts, "score"]
            )

    scored = _plain(docs, id_col, text_col).mapInArrow(work, f"doc_id bigint, {', '.join(f'{c} bigint' for c in counts)}, score double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    grade = F.when(F.col("base_failed"), "rule").when(F.col("score") < keep_at, "low").when(F.col("score") < high_at, "fair").otherwise("high")
    return scored.withColumn("base_failed", failed).select(
        "doc_id", *counts, "base_failed", "score", grade.alias("grade"), (~F.col("base_failed") & (F.col("score") >= keep_at)).alias("kept"),
        (_fold(F.col("doc_id")) == 0).alias("held_out"),
    )
