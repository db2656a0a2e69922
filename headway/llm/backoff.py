"""Language-model scores by stupid backoff from the counts of the whole corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.words import U64, mix64, run_codes, text_column, word_codes

#: Text of a block of documents, and about the text whose n-grams meet in a part of the counts.
BLOCK_BYTES = 8 << 20


def _parts(grams: np.ndarray, parts: int) -> np.ndarray:
    """The part of the count table each n-gram is in: a range of its code."""
    return ((grams >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    """64-bit values by byte plane, so that the many equal upper bytes lie together."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(U64, copy=False)


def _grams(column: pa.Array, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Codes of the n-grams that begin at each word, by n, and the bounds of the rows' words.

    An n-gram that would leave its row has the code 0.
    """
    codes, bounds = word_codes(column)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(codes))  # words from here to the row's end
    out = [mix64(codes ^ U64(0x2545F4914F6CDD1D))]
    for n in range(2, order + 1):
        runs = np.zeros(len(codes), U64)
        found = run_codes(codes, n)
        runs[: len(found)] = found
        runs[left < n] = 0
        out.append(runs)
    return out, bounds


def _own_counts(index: np.ndarray, bounds: np.ndarray, kinds: int) -> np.ndarray:
    """How often each place's n-gram is in its own row."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    _, where, often = np.unique(row * np.int64(kinds + 1) + index, return_inverse=True, return_counts=True)
    return often[where]


def backoff_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 2, discount: float = 0.4, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Stupid-backoff score of every document: doc_id, n_words, log_score (sum) and mean_log_score.

    The score of a word after its n - 1 words before is the count of the n-gram over that of its
    beginning, or ``discount`` times the score with a word less where the n-gram was not seen; a
    word not seen counts as one of all words.  The counts are those of all documents without the
    document itself.  A word is a run of characters other than ASCII white space, A-Z in lower
    case; scores are natural logarithms.

    Documents are dealt into blocks of bounded size.  The n-grams of a block, each once with its
    count, go to the part of the count table that holds their hash range, are added up there, and
    the totals come back to the block; a word common to all texts is one row per block.  Null,
    empty and blank texts have no words, log_score 0 and a null mean.  Repeated rows are documents
    of their own, a null doc_id stays null, other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).first()
    blocks = max(1, -(-(size["b"] or 0) // block_bytes))
    everything = size["n"] or 0
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def count(table: pa.Table) -> pa.Table:
        column = text_column(table.combine_chunks().to_batches()[0], "text")
        grams = np.concatenate(_grams(column, order)[0])
        grams, often = np.unique(grams[grams != 0], return_counts=True)
        cuts = np.searchsorted(_parts(grams, blocks), np.arange(blocks + 1))
        full = np.flatnonzero(np.diff(cuts))
        block = table.column("block")[0].as_py()
        return pa.table(
            {
                "part": pa.array(full, pa.int64()),
                "block": pa.array([block] * len(full), pa.int64()),
                "grams": pa.array([_planes(np.diff(grams[cuts[i] : cuts[i + 1]], prepend=U64(0))) for i in full], pa.binary()),
                "often": pa.array([_planes(often[cuts[i] : cuts[i + 1]]) for i in full], pa.binary()),
            }
        )

    def total(table: pa.Table) -> pa.Table:
        grams = [np.cumsum(_unplaned(x), dtype=U64) for x in table.column("grams").to_pylist()]
        often = np.concatenate([_unplaned(x) for x in table.column("often").to_pylist()])
        _, where = np.unique(np.concatenate(grams), return_inverse=True)
        totals = np.bincount(where, often).astype(U64)[where]
        ends = np.cumsum([len(x) for x in grams])[:-1]
        return pa.table({"block": table.column("block"), "part": table.column("part"), "totals": pa.array([_planes(x) for x in np.split(totals, ends)], pa.binary())})

    def score(texts: pa.Table, counts: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({c: pa.array([], t) for c, t in fields})
        column = text_column(texts.combine_chunks().to_batches()[0], "text")
        levels, bounds = _grams(column, order)
        known = np.unique(np.concatenate(levels))
        known = known[known != 0]
        counts = counts.sort_by("part")
        totals = np.concatenate([np.zeros(0, U64), *map(_unplaned, counts.column("totals").to_pylist())]).astype(float)
        words = np.diff(bounds)
        others = np.maximum(everything - np.repeat(words, words), 1).astype(float)  # words of the other documents
        seen = []  # of the n-gram that begins at each place, elsewhere in the corpus
        for level in levels:
            index = np.searchsorted(known, level)
            own = _own_counts(np.where(level == 0, len(known), index), bounds, len(known))
            seen.append(np.where(level == 0, 0.0, totals[np.minimum(index, len(totals) - 1)] - own) if len(totals) else np.zeros(0))
        # By place of the last word: one word first, then with one more before it each time.
        value = np.log(np.maximum(seen[0], 1.0) / others)
        place = np.arange(len(value)) - np.repeat(bounds[:-1], words)
        for n in range(2, order + 1):
            ends = np.flatnonzero(place >= n - 1)
            begins = ends - (n - 1)
            whole, before = seen[n - 1][begins], seen[n - 2][begins]
            found = whole > 0
            value[ends] = np.where(found, np.log(np.maximum(whole, 1) / np.maximum(before, 1)), np.log(discount) + value[ends])
        sums = np.add.reduceat(np.append(value, 0.0), bounds[:-1]) * (words > 0)
        mean = [s / w if w else None for s, w in zip(sums.tolist(), words.tolist())]
        return pa.table({"doc_id": texts.column("doc_id"), "n_words": pa.array(words), "log_score": pa.array(sums), "mean_log_score": pa.array(mean, pa.float64())})

    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_score", pa.float64()), ("mean_log_score", pa.float64())]
    counted = dealt.groupBy("block").applyInArrow(count, "part bigint, block bigint, grams binary, often binary")
    totals = counted.groupBy("part").applyInArrow(total, "block bigint, part bigint, totals binary")
    return dealt.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(score, "doc_id bigint, n_words bigint, log_score double, mean_log_score double")
