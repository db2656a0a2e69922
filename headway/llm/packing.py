"""Training sequences packed from lexically close documents, found by BM25 within shards."""

from __future__ import annotations

import base64
import functools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from headway.llm.shared import written
from headway.llm.words import U64, bounded, shingles, text_column, word_codes

#: Tokens of a sequence, and about how many of a shard: a task holds one shard at a time.
WINDOW, SHARD_TOKENS = 1024, 1 << 20
#: The usual BM25 parameters, and the share of documents left at which the used ones are cleared out.
K1, B, LEFT = 1.2, 0.75, 0.85

# What a plain text hasn't: white space but spaces and line breaks that stand alone between signs, and the special token.
_ODD = (
    r"[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|[ \n][ \n]|^[ \n]|[ \n]\z|^\z|<\|endoftext\|>"
)
# The rule for runs of white space: it matches nowhere in a plain text, and patterns that look ahead take twice the time.
_AHEAD = r"|\s+(?!\S)|\s+"


class Tokens:
    """Token ids of texts as little-endian bytes.

    The same vocabulary is at hand as ranks, which take a fraction of the time and give the same ids
    for plain text.  ``<|endoftext|>`` and runs of white space go to the tokenizer.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        if pattern.endswith(_AHEAD):
            pattern = pattern.removesuffix(_AHEAD) + r"|\s+"
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, column: pa.Array) -> list[bytes]:
        """The ids of each text of a column without nulls."""
        odd = pc.match_substring_regex(column, _ODD).to_pylist()
        return [self._ids(text, not x) for text, x in zip(column.to_pylist(), odd)]

    def _ids(self, text: str, plain: bool) -> bytes:
        ids = array("I", self.ranks.encode_ordinary(text) if plain else self.whole.encode(text, add_special_tokens=False).ids)
        return np.array(ids, "<u4").tobytes()


@functools.cache
def tokens(json_path: str, ranks_path: str, pattern: str) -> Tokens:
    """One per worker."""
    return Tokens(json_path, ranks_path, pattern)


class Index:
    """BM25 over the documents of a shard, by token id, with the used documents left out."""

    def __init__(self, texts: list[bytes]):
        n = len(texts)
        own = [np.unique(np.frombuffer(t, "<u4"), return_counts=True) for t in texts]
        size = np.array([len(t) / 4 for t in texts])
        doc = np.repeat(np.arange(n), [len(u) for u, _ in own])
        term = np.concatenate([u for u, _ in own]).astype(np.int64)
        often = np.concatenate([c for _, c in own]).astype(float)
        df = np.bincount(term)
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5))
        order = np.argsort(term, kind="stable")
        weight = often * (K1 + 1) / (often + K1 * (1 - B + B * size[doc] / size.mean()))
        self.doc, self.weight = doc[order], (weight * self.idf[term])[order]
        self.begin = np.concatenate([[0], np.cumsum(df)])
        self.terms = [u.astype(np.int64) for u, _ in own]
        self.unused, self.held = np.ones(n, bool), n

    def _clear(self) -> None:
        """Drop the postings of used documents; the weights of the others stay as they are."""
        keep = self.unused[self.doc]
        self.begin = np.concatenate([[0], np.cumsum(keep)])[self.begin]
        self.doc, self.weight = self.doc[keep], self.weight[keep]

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused documents, those that score best for all of the seed's terms first."""
        free = np.flatnonzero(self.unused)
        if len(free) < LEFT * self.held:
            self.held = len(free)
            self._clear()
        begin = self.begin[self.terms[seed]]
        size = self.begin[self.terms[seed] + 1] - begin
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        score = np.bincount(self.doc[at], self.weight[at], len(self.unused))
        return free[np.argsort(-score[free], kind="stable")]


def fill_windows(texts: list[bytes], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, first token, tokens); every token lies in one.

    A seed opens a window.  Its unused neighbours follow by rank, whole where they fit; the best
    one that doesn't is cut to what room is left, and what remains of it is the next seed.
    """
    index = Index(texts)
    size = [len(t) // 4 for t in texts]
    sequences: list[list[tuple[int, int, int]]] = []
    seed, at, nth = -1, 0, 0
    while True:
        if seed < 0:
            while nth < len(texts) and not index.unused[nth]:
                nth += 1
            if nth == len(texts):
                return sequences
            seed, at = nth, 0
            index.unused[seed] = False
        length = min(window, size[seed] - at)
        row, room = [(seed, at, length)], window - length
        at += length
        sequences.append(row)
        if at < size[seed]:
            continue
        last, seed = seed, -1
        if room:
            cut = -1
            for other in index.neighbours(last).tolist():
                if size[other] <= room:
                    index.unused[other] = False
                    row.append((other, 0, size[other]))
                    room -= size[other]
                    if not room:
                        break
                elif cut < 0:
                    cut = other
            if room and cut >= 0:
                index.unused[cut] = False
                row.append((cut, 0, room))
                seed, at = cut, room


def pack(
    docs: DataFrame, json_path: str, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens: one row per piece.

    Returns doc_id, start (tokens of the document before the piece), length, ids_crc32, doc_tokens,
    sequence_id and offset within the sequence; with ``with_ids`` the ids of the piece too.  A
    document is its token ids and a final id 0.  Only the last sequence of a shard may be short.

    Documents are spread by ranges of the least code of their word pairs, so close texts tend to
    meet, and ties are split by doc_id.  A task streams its range and cuts it into shards of about
    ``shard_tokens``; each has its own inverted index.  Null and empty texts are the id 0 alone.
    Repeated rows are packed each, a null doc_id stays null, other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            codes, bounds = shingles(*word_codes(text_column(batch, "text")), 2)
            full = np.flatnonzero(np.diff(bounds))
            key = np.zeros(len(batch), np.int64)
            if len(full):
                key[full] = (np.minimum.reduceat(codes, bounds[full]) >> U64(1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=["doc_id", "text", "close"])

    fields = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    names = [x.split()[0] for x in fields.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens(json_path, ranks_path, pattern).encode_all
        number = TaskContext.get().partitionId() << 36
        ids: list[int | None] = []
        texts: list[bytes] = []

        def shard() -> pa.RecordBatch:
            nonlocal number
            columns: list[list] = [[] for _ in names]
            pieces: list[list[int]] = []
            for row in fill_windows(texts, window):
                offset = 0
                for doc, start, length in row:
                    piece = texts[doc][4 * start : 4 * (start + length)]
                    for column, value in zip(columns, (ids[doc], start, length, zlib.crc32(piece), len(texts[doc]) // 4, number, offset)):
                        column.append(value)
                    if with_ids:
                        pieces.append(np.frombuffer(piece, "<u4").astype(np.int32))
                    offset += length
                number += 1
            ids.clear()
            texts.clear()
            arrays = [pa.array(c, pa.int64()) for c in columns]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(pieces, pa.list_(pa.int32()))], names=[*names, "ids"]) if with_ids else pa.RecordBatch.from_arrays(arrays, names=names)

        held = 0
        for batch in bounded(batches, "text"):
            for doc, text in zip(batch.column(0).to_pylist(), encode(text_column(batch, "text").fill_null(""))):
                ids.append(doc)
                texts.append(text + b"\0\0\0\0")
                held += len(texts[-1]) // 4
                if held >= shard_tokens:
                    yield shard()
                    held = 0
        if texts:
            yield shard()

    # Written, as the ranges are found in a pass of their own.
    near = written(rows.mapInArrow(keyed, "doc_id bigint, text string, close bigint"), "close_texts")
    spread = near.repartitionByRange("close", "doc_id").sortWithinPartitions("close", "doc_id", "text")
    return spread.select("doc_id", "text").mapInArrow(work, fields + (", ids array<int>" if with_ids else ""))
