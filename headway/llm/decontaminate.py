"""Benchmark passages in documents by Wu-Manber search over word codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.shared import written
from headway.llm.words import SIGNS, U64, bounded, mix64, text_column, word_codes

#: Benchmark text searched for in one pass over the documents.
PASS_BYTES = 16 << 20
#: Word positions each of the parallel searches of a text is given.
LANE = 256


class WuManber:
    """Search for many patterns of the same number of words.

    The shift table says how far the end of the window may move on, given the last block of words
    under it: by the whole pattern where the block is in no pattern.  Where it cannot move, the
    block and the first words of the window choose a bucket of patterns, which are compared word
    by word.  All lanes of a text move on together, each by its own shift.
    """

    def __init__(self, patterns: np.ndarray):
        count, self.m = patterns.shape
        self.b = min(2, self.m)
        self.mask = U64((1 << max(12, (4 * count * self.m).bit_length())) - 1)
        self.shift = np.full(int(self.mask) + 1, self.m - self.b + 1, np.int64)
        for j in range(self.m - self.b + 1):
            slot = self._block(patterns[:, j : j + self.b]) & self.mask
            np.minimum.at(self.shift, slot.astype(np.int64), self.m - self.b - j)
        keys = self._bucket(patterns[:, -self.b :], patterns[:, : self.b])
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.patterns = keys[self.order], patterns

    def _block(self, words: np.ndarray) -> np.ndarray:
        return mix64(words[:, 0] + (words[:, 1] << U64(1) if self.b == 2 else U64(0)))

    def _bucket(self, last: np.ndarray, first: np.ndarray) -> np.ndarray:
        return mix64(self._block(last) + U64(3) * self._block(first))

    def find(self, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and pattern number of every occurrence within a row."""
        m, b = self.m, self.b
        sizes = np.maximum(np.diff(bounds) - m + 1, 0)  # windows of each row
        lanes = -(-sizes // LANE)
        row = np.repeat(np.arange(len(sizes)), lanes)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        end = bounds[row] + nth * LANE + m - 1
        stop = np.minimum(end + LANE, bounds[row + 1])
        candidates = []
        while len(end):
            slot = self._block(np.stack([words[end - b + 1 + i] for i in range(b)], 1)) & self.mask
            step = self.shift[slot.astype(np.int64)]
            candidates.append(end[step == 0])
            end = end + np.maximum(step, 1)
            on = end < stop
            end, stop = end[on], stop[on]
        start = np.concatenate([*candidates, np.zeros(0, np.int64)]) - m + 1
        if not len(start):
            return start, start
        keys = self._bucket(np.stack([words[start + m - b + i] for i in range(b)], 1), np.stack([words[start + i] for i in range(b)], 1))
        low, high = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
        start = np.repeat(start, high - low)
        nth = np.arange(len(start)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        pattern = self.order[np.repeat(low, high - low) + nth]
        same = np.ones(len(start), bool)
        for j in range(m):
            same &= words[start + j] == self.patterns[pattern, j]
        return start[same], pattern[same]


def windows(items: list[tuple[str, str | None]], width: int) -> list[tuple[np.ndarray, list[list[str]]]]:
    """Distinct windows of the items by length: codes (patterns x words) and the items of each."""
    codes, bounds = word_codes(pa.array([text for _, text in items], pa.string()), SIGNS)
    groups: dict[int, dict[bytes, set[str]]] = {}
    for i, (item, _) in enumerate(items):
        own = codes[bounds[i] : bounds[i + 1]]
        m = min(width, len(own))
        for j in range(len(own) - m + 1 if m else 0):
            groups.setdefault(m, {}).setdefault(own[j : j + m].tobytes(), set()).add(item)
    return [(np.frombuffer(b"".join(g), U64).reshape(len(g), m), [sorted(x) for x in g.values()]) for m, g in groups.items()]


def _search(docs: DataFrame, items: list[tuple[str, str | None]], width: int) -> DataFrame:
    """The frame (doc_id, text, spans, items) with what the given items add to the last two."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(windows(items, width))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [(WuManber(patterns), named) for patterns, named in shared.value]
        for batch in bounded(batches, "text"):
            codes, bounds = word_codes(text_column(batch, "text"), SIGNS)
            spans: dict[int, list[int]] = {}
            items: dict[int, set[str]] = {}
            for search, named in searches:
                start, pattern = search.find(codes, bounds)
                for row, s, p in zip((np.searchsorted(bounds, start, "right") - 1).tolist(), start.tolist(), pattern.tolist()):
                    spans.setdefault(row, []).extend((s - int(bounds[row]), s - int(bounds[row]) + search.m))
                    items.setdefault(row, set()).update(named[p])
            old_spans, old_items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([x + spans.get(i, []) for i, x in enumerate(old_spans)], pa.list_(pa.int64())),
                    pa.array([x + sorted(items.get(i, ())) for i, x in enumerate(old_items)], pa.list_(pa.string())),
                    pa.array(np.diff(bounds)),
                    pa.array([_covered(x + spans.get(i, [])) for i, x in enumerate(old_spans)], pa.int64()),
                ],
                names=["doc_id", "text", "spans", "items", "n_words", "n_hit"],
            )

    return docs.select("doc_id", "text", "spans", "items").mapInArrow(
        work, "doc_id bigint, text string, spans array<bigint>, items array<string>, n_words bigint, n_hit bigint"
    )


def _covered(spans: list[int]) -> int:
    """Words inside any of the spans (start, end, start, end ...)."""
    total = reached = 0
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        total += max(0, end - max(start, reached))
        reached = max(reached, end)
    return total


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 10,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Per document: its words, the words inside benchmark windows, and the items they come from.

    Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the spans of the hits
    (start and end word, one after the other).  A word is a run of digits, letters a-z (A-Z in
    lower case) and characters beyond ASCII.  A window is ``width`` consecutive words of an item;
    an item with fewer words is one window, one without words has none.

    The benchmark is searched for in passes over the documents, each with at most about
    ``pass_bytes`` of its text in memory, so it may be of any size.  Null texts have no words.  An
    item without an id goes by the empty id, items with the same id are one, rows of documents are
    each on their own.  Other columns are ignored.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).cast("string").alias("text")
    ).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // pass_bytes))
    frame = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.array().cast("array<bigint>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for i in range(passes):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == i).collect()
        frame = _search(frame, [tuple(x) for x in part], width)
        if i < passes - 1:
            frame = written(frame, "searched")
    ids = F.array_sort(F.array_distinct("items"))
    return frame.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "spans",
    )
