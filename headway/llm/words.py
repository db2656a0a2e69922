"""Words and word shingles of Arrow text columns as 64-bit codes, without a Python object per word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text looked at together.
CHUNK = 1 << 18


def _table(separators) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(separators)] = True
    return out


#: Bytes between words: white space only, or every ASCII byte but digits and small letters.
WHITE = _table([0x20, *range(0x09, 0x0E)])
SIGNS = _table([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[0x41:0x5B] += 32

#: Bytes of a run from which a library hash is taken.
LONG = 64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n + 1 bounds of its rows in them; null is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), bounds


def word_chunks(column: pa.Array, separators: np.ndarray) -> Iterator[tuple]:
    """The text in pieces that end where a word ends: where its words start and end in the bytes,
    the piece's bytes with A-Z in lower case, and where it begins (see ``run_of_bytes``).
    """
    data, bounds = text_bytes(column)
    at, last = int(bounds[0]), int(bounds[-1])
    while at < last:
        size = CHUNK
        while True:  # a chunk ends before a separator or at the end of a row
            end = min(at + size, last)
            if end == last or separators[_SMALL[data[end]]]:
                break
            part = separators[_SMALL[data[at:end]]]
            cut = max(int(np.flatnonzero(part)[-1]) if part.any() else 0, int(bounds[np.searchsorted(bounds, end, "right") - 1]) - at)
            if cut > 0:
                end = at + cut
                break
            size *= 2
        low = _SMALL[data[at:end]]
        word = ~separators[low]
        first = np.zeros(end - at + 1, bool)
        first[0] = first[-1] = True
        inner = bounds[np.searchsorted(bounds, at) : np.searchsorted(bounds, end)] - at
        first[inner] = True
        begin = word & first[:-1]
        begin[1:] |= word[1:] & ~word[:-1]
        stop = word & first[1:]
        stop[:-1] |= word[:-1] & ~word[1:]
        yield np.flatnonzero(begin) + at, np.flatnonzero(stop) + 1 + at, low, at
        at = end


def run_of_bytes(chunk, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit codes of the byte runs from ``starts`` to ``ends`` within a chunk.

    Blocks of 8 bytes are mixed in one after the other by a bijection, so runs of up to 8 bytes never
    share a code with one of their length; long runs get a library hash.
    """
    low, at = chunk[2:]
    size = ends - starts
    # A 64-bit value at every byte; nothing is copied but what is looked up.
    padded = np.concatenate([low, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(low) + 1, "<u8", padded, strides=(1,))
    out = mix64(size.astype(U64) * U64(0x9E3779B97F4A7C15))
    short = np.flatnonzero(size <= LONG)
    for begin in range(0, LONG, 8):
        short = short[size[short] > begin]
        if not len(short):
            break
        left = np.minimum(size[short] - begin, 8).astype(U64)
        block = blocks[starts[short] - at + begin] & (U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - left * U64(8)))
        out[short] = mix64((out[short] ^ block) * U64(0xD1342543DE82EF95) + U64(begin))
    for i in np.flatnonzero(size > LONG).tolist():
        run = low[starts[i] - at : ends[i] - at].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(run, digest_size=8).digest(), "little")
    return out


def word_codes(column: pa.Array, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of all words, A-Z in lower case, and the n + 1 bounds of the rows' words."""
    bounds = text_bytes(column)[1]
    codes, starts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for chunk in word_chunks(column, separators):
        codes.append(run_of_bytes(chunk, chunk[0], chunk[1]))
        starts.append(chunk[0])
    return np.concatenate(codes), np.searchsorted(np.concatenate(starts), bounds)


_STEPS = [U64(pow(0xD1342543DE82EF95, j + 1, 1 << 64)) for j in range(64)]


def run_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """Codes of all runs of ``width`` consecutive words, over the bounds of rows too."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = codes[:n] * _STEPS[0]
    for j in range(1, width):
        out += codes[j : j + n] * _STEPS[j]
    return mix64(out + U64(width))


def shingles(codes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each row's runs of ``width`` words; a row of fewer words has its whole sequence as one.

    Returns the codes and the n + 1 bounds of the rows in them; a row without words has none.
    """
    words = np.diff(bounds)
    sizes = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(ends[-1]), U64)
    runs = run_codes(codes, width)
    long = words >= width
    at = np.repeat(bounds[:-1] - ends[:-1], sizes) + np.arange(len(out))  # where each run begins
    of_long = np.repeat(long, sizes)
    out[of_long] = runs[at[of_long]]
    short = np.flatnonzero((words > 0) & ~long)
    if len(short):
        total = np.zeros(len(short), U64)
        for j in range(width - 1):
            has = words[short] > j
            total[has] += codes[bounds[short[has]] + j] * _STEPS[j]
        out[ends[short]] = mix64(total + words[short].astype(U64))
    return out, ends


def bounded(batches: Iterator[pa.RecordBatch], name: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``most`` bytes of text, or one row."""
    for batch in batches:
        bounds = text_bytes(text_column(batch, name))[1]
        at = 0
        while at < len(batch):
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column of a batch, empty texts for null."""
    column = batch.column(batch.schema.get_field_index(name))
    return column if column.type in (pa.string(), pa.large_string()) else column.cast(pa.string())
