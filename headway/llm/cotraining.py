"""Document quality by co-training a text view and a page-metadata view."""

from __future__ import annotations

import copy
import zlib
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.logistic import Logistic, sigmoid
from headway.llm.shared import written
from headway.llm.words import bounded, text_bytes, text_column, word_codes

#: Kinds of bytes; the text view counts which kind follows which.
_KIND = np.full(256, 11, np.uint8)  # other signs
for _kind, _chars in enumerate(
    ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,;:?", "!", "|", "#$%&*", "'\"()-"]
):
    _KIND[[ord(c) for c in _chars]] = _kind
_KIND[128:] = 10  # beyond ASCII
KINDS = 12
TEXT_WIDTH = KINDS * KINDS + 4
META_SLOTS = 32
META_WIDTH = META_SLOTS + 4


def text_view(column: pa.Array) -> np.ndarray:
    """Rows x TEXT_WIDTH: how often each kind of byte follows each, repeated words, word length."""
    data, bounds = text_bytes(column)
    n, size = len(column), np.diff(bounds)
    out = np.zeros((n, TEXT_WIDTH))
    start = int(bounds[0])
    kinds = _KIND[data[start : bounds[-1]]].astype(np.int64)
    row = np.repeat(np.arange(n), size)
    if len(kinds) > 1:
        within = row[1:] == row[:-1]
        cell = (row[1:] * KINDS + kinds[:-1]) * KINDS + kinds[1:]
        out[:, :-4] = np.bincount(cell[within], minlength=n * KINDS * KINDS).reshape(n, -1)
    out[:, :-4] = np.sqrt(out[:, :-4] / np.maximum(size - 1, 1)[:, None])
    codes, at = word_codes(column)
    words = np.diff(at)
    owner = np.repeat(np.arange(n), words)
    for j in (1, 2):
        same = (codes[j:] == codes[:-j]) & (owner[j:] == owner[:-j])
        out[:, -5 + j] = np.bincount(owner[j:][same], minlength=n) / np.maximum(words, 1)
    out[:, -2] = np.log1p(size / np.maximum(words, 1))
    out[:, -1] = np.log1p(words)
    return out


def meta_view(column: pa.Array, named: Sequence[tuple[str, list]], n_chars: list) -> np.ndarray:
    """Rows x META_WIDTH: hashed names and values of the metadata columns, length and layout."""
    data, bounds = text_bytes(column)
    out = np.zeros((len(column), META_WIDTH))
    for name, values in named:
        for i, value in enumerate(values):
            out[i, zlib.crc32(f"{name}={value}".encode()) % META_SLOTS] = 1
    lines = np.searchsorted(np.flatnonzero(data[: bounds[-1]] == 10), bounds)
    count = np.diff(lines) + 1
    out[:, -4] = np.log1p(np.array([x or 0 for x in n_chars], float).clip(0))
    out[:, -3] = [x is None for x in n_chars]
    out[:, -2] = np.log1p(count)
    out[:, -1] = np.log1p(np.diff(bounds) / count)
    return out


#: Bins of the calibrated log-odds, 16 of them in a unit, from which the cuts are taken.
BINS = 512


class Quality(NamedTuple):
    """Two view models, the model of their calibrated scores and the rows handed over in each round."""

    text: Logistic
    meta: Logistic
    calibrated: tuple[Logistic, Logistic]
    both: Logistic
    handed: tuple[tuple[int, int], ...] = ()  # by the text view, by the metadata view

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated scores of the text view, of the metadata view and of both."""
        a = self.calibrated[0].logit(self.text.logit(text)[:, None])
        b = self.calibrated[1].logit(self.meta.logit(meta)[:, None])
        return sigmoid(a), sigmoid(b), self.both.score(np.column_stack([a, b]))


class Teacher(NamedTuple):
    """A view that labels free rows: those in the bins up to ``low`` and from ``high`` on."""

    model: Logistic
    calibrated: Logistic
    low: int = -1
    high: int = BINS

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated.logit(self.model.logit(x)[:, None])

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.clip((self.logit(x) + BINS / 32) * 16, 0, BINS - 1).astype(int)

    def sure(self, x: np.ndarray) -> np.ndarray:
        where = self.bins(x)
        return (where <= self.low) | (where >= self.high)

    def cut(self, counts: np.ndarray, share: float) -> Teacher:
        """The teacher with the cuts that leave ``share`` of the counted rows, or their bin, at each end."""
        most = share * counts.sum()
        low = int(np.searchsorted(np.cumsum(counts), most))
        high = BINS - 1 - int(np.searchsorted(np.cumsum(counts[::-1]), most))
        return self._replace(low=low, high=high)


def _explained(logit: np.ndarray, y: np.ndarray) -> float:
    """The part of the labels' deviance that the scores explain, 0 to 1."""
    if not 0 < y.sum() < len(y):
        return 0.0
    deviance = lambda p: -np.mean(np.log(np.where(y == 1, p, 1 - p)))
    return max(0.0, 1 - deviance(np.clip(sigmoid(logit), 1e-9, 1 - 1e-9)) / deviance(np.full(len(y), y.mean())))


def _newton(model: Logistic, x: np.ndarray, y: np.ndarray, weight: float) -> np.ndarray:
    """Gradient and Hessian of the weighted log-likelihood, in one array."""
    z = model._design(x)
    p = sigmoid(z @ model.beta)
    hessian = (z * (p * (1 - p))[:, None]).T @ z
    return weight * np.concatenate([z.T @ (y - p), hessian.ravel()])


def cotrain(
    text: np.ndarray, meta: np.ndarray, y: np.ndarray, total: Callable[[Callable], np.ndarray],
    rounds: int = 4, share: float = 0.1, trust: float = 0.5, steps: int = 3,
) -> Quality:
    """Train the views on labelled rows, each giving the other its surest labels of all free rows.

    ``total(f)`` is the sum of the arrays f(text, meta) over all free rows, so nothing here grows
    with them.  In a round each view labels the free rows at both ends of its calibrated scores,
    ``share`` of all free rows at each end.  The label is the calibrated score.  What a view is
    given weighs ``trust`` times its labelled rows in all, whatever the number of free rows, times
    the part of the kept back labels' deviance that the other view explains: a view that knows
    little says little.  ``steps`` Newton steps follow, each a sum over the free rows.  Every
    fourth labelled row is kept back to calibrate the two scores and to combine them.
    """
    held = np.arange(len(y)) % 4 == 3
    views, known = (text, meta), y[~held]
    models = [Logistic(3.0).fit(v[~held], known) for v in views]
    for model in models:
        model.scale[model.scale <= 1e-6] = 1.0  # a value the labelled rows share; its weight is 0

    def calibrate() -> list[Logistic]:
        return [Logistic(0.1).fit(m.logit(v[held])[:, None], y[held]) for m, v in zip(models, views)]

    calibrated, handed = calibrate(), []
    for _ in range(rounds if 0 < known.sum() < len(known) else 0):
        teachers = [Teacher(copy.deepcopy(m), c) for m, c in zip(models, calibrated)]
        counts = total(lambda *rows: np.concatenate([np.bincount(t.bins(x), minlength=BINS) for t, x in zip(teachers, rows)]))
        if not counts.sum():
            break
        counts = counts.reshape(2, BINS)
        teachers = [t.cut(n, share) for t, n in zip(teachers, counts)]
        given = [int(sum(n for i, n in enumerate(c) if i <= t.low or i >= t.high)) for t, c in zip(teachers, counts)]
        handed.append(tuple(given))
        worth = [trust * len(known) * _explained(t.logit(v[held]), y[held]) / n for t, v, n in zip(teachers, views, given)]

        def lessons(*rows: np.ndarray) -> np.ndarray:
            out = []
            for k in (0, 1):
                teacher, seen = teachers[1 - k], rows[1 - k]
                sure = teacher.sure(seen)
                out.append(_newton(models[k], rows[k][sure], sigmoid(teacher.logit(seen[sure])), worth[1 - k]))
            return np.concatenate(out)

        for _ in range(steps):
            sums = np.split(total(lessons), [_size(models[0])])
            for model, view, more in zip(models, views, sums):
                _advance(model, _newton(model, view[~held], known, 1.0) + more)
        calibrated = calibrate()
    logits = [c.logit(m.logit(v[held])[:, None]) for m, c, v in zip(models, calibrated, views)]
    both = Logistic(0.1).fit(np.column_stack(logits), y[held])
    return Quality(models[0], models[1], (calibrated[0], calibrated[1]), both, tuple(handed))


def _size(model: Logistic) -> int:
    return len(model.beta) * (len(model.beta) + 1)


def _advance(model: Logistic, sums: np.ndarray) -> None:
    """One Newton step on the sums of gradient and Hessian."""
    k = len(model.beta)
    penalty = np.diag([1e-6] + [model.ridge] * (k - 1))
    step = np.linalg.solve(sums[k:].reshape(k, k) + penalty, sums[:k] - penalty @ model.beta)
    model.beta = model.beta + step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))


def _views(batch: pa.RecordBatch, meta: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The views of a batch (id, text, n_chars, metadata columns...), to the precision they are stored with."""
    column = text_column(batch, "text")
    named = [(c, batch.column(3 + i).to_pylist()) for i, c in enumerate(meta)]
    return text_view(column).astype(np.float32), meta_view(column, named, batch.column(2).to_pylist()).astype(np.float32)


def _stored(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, width).astype(float)


def _summed(rows: DataFrame) -> Callable[[Callable], np.ndarray]:
    """Sums of f(text, meta) over the views (a, b) of all rows: each task sends one value a position."""

    def total(f: Callable) -> np.ndarray:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = None
            for batch in batches:
                if len(batch):
                    part = f(_stored(batch.column(0), TEXT_WIDTH), _stored(batch.column(1), META_WIDTH))
                    out = part if out is None else out + part
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out), dtype=np.int32)), pa.array(out.astype(float))], names=["at", "value"])

        sums = rows.select("a", "b").mapInArrow(work, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
        return np.array([r["value"] for r in sorted(sums.collect(), key=lambda r: r["at"])])  # as long as the model, not the table

    return total


def _plain(docs: DataFrame, id_col: str, text_col: str, chars_col: str, meta: Sequence[str]) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(chars_col).cast("bigint").alias("n_chars"),
        *[F.col(c).cast("string").alias(f"meta{i}") for i, c in enumerate(meta)],
    )


def held_out(doc_id) -> F.Column:
    """Whether a document is kept apart from all learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
    meta: Sequence[str] = ("lang", "source"), sample: int = 6000,
) -> tuple[Quality, DataFrame]:
    """Models, and the written views (doc_id, quality, a, b) of all rows.

    At most ``sample`` labelled documents teach, those with the smallest hashes; all other rows
    that are not held out are free.
    """
    plain = _plain(docs, id_col, text_col, chars_col, meta)
    known = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "sample")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            packed = [pa.array([x.tobytes() for x in view], pa.binary()) for view in _views(batch, meta)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(len(batch.columns) - 1), *packed], names=["doc_id", "quality", "a", "b"])

    rows = plain.join(F.broadcast(chosen), "doc_id", "left").mapInArrow(work, "doc_id bigint, quality int, a binary, b binary")
    rows = written(rows, "views")
    # One row an id, so the sample's size bounds what is collected.
    found = rows.where("quality is not null").groupBy("doc_id").agg(F.min(F.struct("quality", "a", "b")).alias("r")).orderBy("doc_id").collect()
    table = lambda c, width: np.array([np.frombuffer(r["r"][c], np.float32) for r in found], float).reshape(-1, width)
    y = np.array([r["r"]["quality"] for r in found], float)
    free = rows.where(F.col("quality").isNull() & ~held_out(F.col("doc_id")))
    return cotrain(table("a", TEXT_WIDTH), table("b", META_WIDTH), y, _summed(free)), rows


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
    meta: Sequence[str] = ("lang", "source"), sample: int = 6000,
) -> DataFrame:
    """Quality of every document: doc_id, held_out, text_score, meta_score, score and keep.

    The text view sees the text alone: kinds of neighbouring bytes, repeated words, word lengths.
    The metadata view sees the ``meta`` columns, the stated length and the layout in lines.  keep is
    score >= 0.5.  Null text is empty, null metadata a value of its own; a null doc_id is never
    held out.  Of labelled rows that share an id one teaches.  With labels of one kind only every
    score is their share, without any labels 0.5.  Other columns are ignored.
    """
    model, views = learn(docs, labels, id_col, text_col, chars_col, meta, sample)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_stored(batch.column(1), TEXT_WIDTH), _stored(batch.column(2), META_WIDTH))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, scores)], names=["doc_id", "text_score", "meta_score", "score"])

    scored = views.select("doc_id", "a", "b").mapInArrow(work, "doc_id bigint, text_score double, meta_score double, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text_score", "meta_score", "score", (F.col("score") >= 0.5).alias("keep"))


def keep_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
    meta: Sequence[str] = ("lang", "source"), sample: int = 6000,
) -> DataFrame:
    """The rows of ``docs`` that ``score_quality`` keeps, as they are; its docstring has the odd cases."""
    model, _ = learn(docs, labels, id_col, text_col, chars_col, meta, sample)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, text_col, 1 << 20):
            get = lambda c: batch.column(batch.schema.get_field_index(c))
            plain = pa.RecordBatch.from_arrays(
                [get(id_col), text_column(batch, text_col), get(chars_col), *[get(c).cast(pa.string()) for c in meta]],
                names=["doc_id", "text", "n_chars", *[f"meta{i}" for i in range(len(meta))]],
            )
            yield batch.filter(pa.array(model.scores(*(view.astype(float) for view in _views(plain, meta)))[2] >= 0.5))

    return docs.mapInArrow(work, docs.schema)
