"""Alignment of two tokenizers: where both end a token, by fragments of byte ranges that compose."""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from headway.llm.shared import written
from headway.llm.words import bounded, text_column

#: Characters from which a text is cut into byte ranges of about that size, and fragments composed at once.
RANGE, FAN_IN = 1 << 15, 16
#: Characters of the units whose tokens a worker keeps; the store is emptied when it is full.
KEPT = 4_000_000
#: A link as one number: B's id and A's id.
HIGH = 1 << 32

#: A space after any sign but white space, and before any.  A ends a token there, as its pattern begins one at a space;
#: B does, as none of its pieces has a space after another sign.
_CUT = re.compile(r"(?<=[^\s]) (?!\Z)")
# White space other than the space and the line break.
_RARE = re.compile(r"[^\S \n]")


class Fragment(NamedTuple):
    """The tokens that end within a byte range, cut into groups where tokens of both kinds end.

    With ``cuts`` such places the tokens are those up to the first (head), the groups between (body,
    ``a1,a2|b1`` joined by ``;``), and those after the last (tail).  Without any, all are in the tail.
    ``plain`` says whether the tokens spell the text.
    """

    plain: bool = True
    n_a: int = 0
    n_b: int = 0
    cuts: int = 0
    head_a: str = ""
    head_b: str = ""
    body: str = ""
    tail_a: str = ""
    tail_b: str = ""


FIELDS = "plain boolean, n_a bigint, n_b bigint, cuts bigint, head_a string, head_b string, body string, tail_a string, tail_b string"
_TYPES = [pa.bool_(), *[pa.int64()] * 3, *[pa.string()] * 5]


def _with(mark: str, *parts: str) -> str:
    return mark.join(filter(None, parts))


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative, with ``Fragment()`` as its neutral element."""
    counts = (x.plain and y.plain, x.n_a + y.n_a, x.n_b + y.n_b, x.cuts + y.cuts)
    if not y.cuts:
        return Fragment(*counts, x.head_a, x.head_b, x.body, _with(",", x.tail_a, y.tail_a), _with(",", x.tail_b, y.tail_b))
    a, b = _with(",", x.tail_a, y.head_a), _with(",", x.tail_b, y.head_b)
    if not x.cuts:
        return Fragment(*counts, a, b, y.body, y.tail_a, y.tail_b)
    return Fragment(*counts, x.head_a, x.head_b, _with(";", x.body, f"{a}|{b}", y.body), y.tail_a, y.tail_b)


def compose_all(parts: list[Fragment]) -> Fragment:
    """All of ``parts`` in order, as a tree: every sign is copied once a level."""
    while len(parts) > 1:
        parts = [functools.reduce(compose, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0] if parts else Fragment()


def groups_text(whole: Fragment) -> str:
    """The groups of a whole document."""
    return _with(";", f"{whole.head_a}|{whole.head_b}", whole.body) if whole.cuts else ""


class Pair:
    """The two tokenizers on the same text; one per worker.

    Texts are cut into units, at whose ends both kinds of tokens end, so a text's groups are those of
    its units.  Each distinct unit is tokenized once as long as the store lasts.
    """

    def __init__(self, json_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(json_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        signs = _byte_signs()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        spelled = {i: t.encode() if t in special else bytes(signs[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.digits = pa.array([str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))])
        # Texts may be cut at spaces only if neither kind of token crosses such a place.
        split = json.loads(self.a.pre_tokenizer.__getstate__()) if self.a.pre_tokenizer else {}
        inner = any(not self.b.is_control(i) and "▁" in p.lstrip("▁") for i, p in enumerate(pieces))
        self.can_cut = not inner and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        self._clear()

    def _clear(self) -> None:
        self.kept = 0
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        #: plain, n_a, n_b and n_groups of each unit; the links of all units in a row.
        self.counts = np.zeros((0, 4), np.int32)
        self.links, self.begin = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def units(self, text: str) -> list[str]:
        if not self.can_cut:
            return [text]
        if text[:1] != " " and text[-1:] != " " and "  " not in text and "\n " not in text and not _RARE.search(text):
            return text.split(" ")
        return _CUT.split(text)

    def tokens(self, text: str) -> tuple[list[int], list[int], list[int], list[int], bool]:
        """Ids and end offsets of A's and B's tokens of a space and ``text``, and whether they spell it."""
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        ends = lambda ids, size: np.cumsum(size[np.array(ids, int)]).tolist()
        return a, b, ends(a, self.a_size), ends(b, self.b_size), self._spells((" " + text).encode(), a, b)

    def _spells(self, stream: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join(map(self.a_bytes.__getitem__, a)) == stream and b"".join(map(self.b_bytes.__getitem__, b)) == stream

    def numbers(self, units: list[str]) -> np.ndarray:
        """The places of units in the store."""
        found = list(map(self.number.get, units))
        if None in found:
            new = list(dict.fromkeys(u for u, number in zip(units, found) if number is None))
            if self.kept and self.kept + sum(map(len, new)) > KEPT:
                self._clear()
                new = list(dict.fromkeys(units))
            self.kept += sum(map(len, new))
            self._learn(new)
            found = list(map(self.number.__getitem__, units))
        return np.array(found, np.int64)

    def _learn(self, units: list[str]) -> None:
        a_ids = [x.ids for x in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        b_ids = self.b.encode(units, num_threads=1)
        plain = np.ones(len(units), bool)
        flat = lambda ids: np.fromiter(itertools.chain.from_iterable(ids), np.int64)
        a, b = flat(a_ids), flat(b_ids)
        length = np.array([len(u.encode()) + 1 for u in units])
        n_a, n_b = (np.array(list(map(len, ids))) for ids in (a_ids, b_ids))
        whole = lambda ids, size, n: np.array_equal(np.add.reduceat(size[ids], np.concatenate([[0], np.cumsum(n)[:-1]])), length)
        if n_a.min() and n_b.min() and whole(a, self.a_size, n_a) and whole(b, self.b_size, n_b) and self._spells((" " + " ".join(units)).encode(), a.tolist(), b.tolist()):
            pass
        else:
            plain = np.array([self._spells((" " + u).encode(), x, y) for u, x, y in zip(units, a_ids, b_ids)])
            a, b = (flat(ids for ids, good in zip(side, plain) if good) for side in (a_ids, b_ids))
            n_a, n_b = n_a * plain, n_b * plain
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_cut, b_cut = (np.flatnonzero(np.isin(x, y, assume_unique=True)) for x, y in ((a_end, b_end), (b_end, a_end)))
        # No token is empty, so each group has one link: its last tokens.
        links = b[b_cut] * HIGH + a[a_cut]
        joined = lambda parts, ends, mark: pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), parts), mark)
        groups = pc.binary_join_element_wise(joined(self.digits.take(pa.array(a)), a_cut + 1, ","), joined(self.digits.take(pa.array(b)), b_cut + 1, ","), "|")
        ends = np.searchsorted(a_cut, np.cumsum(n_a))  # groups up to each unit's end
        self.number.update(zip(units, itertools.count(len(self.groups))))
        self.groups.extend(joined(groups, ends, ";").to_pylist())
        self.counts = np.concatenate([self.counts, np.column_stack([plain, n_a, n_b, np.diff(ends, prepend=0)]).astype(np.int32)])
        self.links = np.concatenate([self.links, links])
        self.begin = np.cumsum(self.counts[:, 3], dtype=np.int64) - self.counts[:, 3]

    def text_of(self, numbers: np.ndarray) -> str:
        """The groups of consecutive units; those of a unit that isn't spelled are empty."""
        return ";".join(map(self.groups.__getitem__, numbers.tolist()))

    def counted(self, numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The codes of the links of each row of units, how often each occurs in it, and the rows' bounds in them."""
        n = len(bounds) - 1
        row = np.repeat(np.arange(n), np.diff(bounds))
        key, often = np.unique(row * (len(self.groups) + 1) + numbers, return_counts=True)
        row, unit = key // (len(self.groups) + 1), key % (len(self.groups) + 1)
        size = self.counts[unit, 3].astype(np.int64)
        begin = self.begin[unit]
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        known, place = np.unique(self.links[at], return_inverse=True)
        key, where = np.unique(np.repeat(row, size) * (len(known) + 1) + place, return_inverse=True)
        total = np.bincount(where, np.repeat(often, size), len(key)).astype(np.int64)
        return known[key % (len(known) + 1)] if len(key) else known, total, np.searchsorted(key // (len(known) + 1), np.arange(n + 1))


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: itself where it is printable
    Latin-1, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.cache
def pair(json_path: str, piece_path: str) -> Pair:
    return Pair(json_path, piece_path)


def ranged(a: list[int], b: list[int], a_ends: list[int], b_ends: list[int], low: int, high: int) -> tuple[Fragment, list[int]]:
    """The fragment of the tokens that end after ``low`` and up to ``high``, and the links among them."""
    a = [(i, end) for i, end in zip(a, a_ends) if low < end <= high]
    b = [(i, end) for i, end in zip(b, b_ends) if low < end <= high]
    both = sorted({end for _, end in a} & {end for _, end in b})
    groups, links, i, j = [], [], 0, 0
    for end in both:
        i_to, j_to = i, j
        while i_to < len(a) and a[i_to][1] <= end:
            i_to += 1
        while j_to < len(b) and b[j_to][1] <= end:
            j_to += 1
        groups.append((_ids(a[i:i_to]), _ids(b[j:j_to])))
        # All tokens that end here; more than one of a kind only if some are empty.
        links.extend(y * HIGH + x for x, at in a[i:i_to] if at == end for y, to in b[j:j_to] if to == end)
        i, j = i_to, j_to
    head = groups[0] if groups else ("", "")
    body = ";".join(f"{x}|{y}" for x, y in groups[1:])
    return Fragment(True, len(a), len(b), len(both), *head, body, _ids(a[i:]), _ids(b[j:])), links


def _ids(tokens: list[tuple[int, int]]) -> str:
    return ",".join(str(i) for i, _ in tokens)


def _units_fragment(tokens: Pair, numbers: np.ndarray) -> Fragment:
    """The fragment of consecutive units."""
    plain, n_a, n_b, cuts = (int(x) for x in (tokens.counts[numbers, 0].all(), *tokens.counts[numbers, 1:].sum(0, dtype=np.int64)))
    if not plain:
        return Fragment(False)
    head, _, body = tokens.text_of(numbers).partition(";")
    head_a, _, head_b = head.partition("|")
    return Fragment(True, n_a, n_b, cuts, head_a, head_b, body)


def range_fragment(tokens: Pair, text: str, start: int, low: int, high: int) -> tuple[Fragment, np.ndarray, np.ndarray]:
    """The fragment of the byte range from ``low`` to ``high`` of a document's stream; its links and how often each occurs.

    ``text`` is a run of whole units that covers the range; it begins at byte ``start`` of the stream,
    which is a space before the document's text.
    """
    units = tokens.units(text)
    ends = start + np.cumsum([len(u.encode()) + 1 for u in units])
    begins = np.concatenate([[start], ends[:-1]])
    inner = np.flatnonzero((begins >= low) & (ends <= high))
    first, last = (int(inner[0]), int(inner[-1]) + 1) if len(inner) else (len(units), len(units))
    parts, codes = [], []

    def edge(numbers) -> None:
        # A unit that lies across the range's bound: its tokens go to the range they end in.
        for i in numbers:
            *found, plain = tokens.tokens(units[i])
            part, own = ranged(*found, low - int(begins[i]), high - int(begins[i]))
            parts.append(part._replace(plain=plain))
            codes.append(np.array(own, np.int64))

    edge(range(first))
    if len(inner):
        numbers = tokens.numbers(units[first:last])
        parts.append(_units_fragment(tokens, numbers))
        code, often, _ = tokens.counted(numbers, np.array([0, len(numbers)]))
        codes.append(np.repeat(code, often))
    edge(range(last, len(units)))
    code, often = np.unique(np.concatenate([np.zeros(0, np.int64), *codes]), return_counts=True)
    return compose_all(parts), code, often


def byte_ranges(tokens: Pair, text: str, size: int) -> Iterator[tuple[int, int, int, str]]:
    """Byte ranges of about ``size`` of a document's stream, as (start, low, high, text of the units it touches).

    Ranges are cut wherever they happen to end.  Only a unit longer than ``size`` stays in the
    range it began in, so that no range has to read it again from its beginning.
    """
    bounds, at = [], 0
    starts, lengths = [], []
    units = tokens.units(text)
    for unit in units:
        starts.append(at)
        lengths.append(len(unit.encode()) + 1)
        at += lengths[-1]
    begin, length = np.array(starts), np.array(lengths)
    low = 0
    while low < at:
        high = min(low + size, at)
        i = int(np.searchsorted(begin, high, "right")) - 1
        if high < at and begin[i] < high and length[i] > size:
            high = int(begin[i] + length[i])
        bounds.append((low, high))
        low = high
    for low, high in bounds:
        first = int(np.searchsorted(begin, low, "right")) - 1
        last = int(np.searchsorted(begin, high, "left"))
        yield int(begin[first]), low, high, " ".join(units[first:last])


_LINKS = [pa.list_(pa.int64()), pa.list_(pa.int64())]
_DONE = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, codes array<bigint>, often array<bigint>"
_DONE_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *_LINKS]


def _names(fields: str) -> list[str]:
    return [x.split()[0] for x in fields.split(", ")]


def _digest(groups: str) -> str:
    return hashlib.sha256(groups.encode()).hexdigest()


def _lists(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))


def _whole_texts(tokens: Pair, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    """Rows of whole documents; a text whose tokens don't spell it has none."""
    split = [tokens.units(t) if t else [] for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(u) for u in split])]).astype(np.int64)
    numbers = tokens.numbers(list(itertools.chain.from_iterable(split)))
    total = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(tokens.counts[numbers], 0, dtype=np.int64)])
    counts = total[bounds[1:]] - total[bounds[:-1]]
    plain = (counts[:, 0] == np.diff(bounds)) & (np.diff(bounds) > 0)
    digests = [_digest(tokens.text_of(numbers[i:j])) if good else "" for i, j, good in zip(bounds[:-1], bounds[1:], plain)]
    used = numbers[np.repeat(plain, np.diff(bounds))]
    codes, often, at = tokens.counted(used, np.concatenate([[0], np.cumsum(np.diff(bounds) * plain)]))
    at = pa.array(at.astype(np.int32))
    columns = [ids, *[pa.array(counts[:, i] * plain) for i in (1, 2, 3)], pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(at, pa.array(codes)), pa.ListArray.from_arrays(at, pa.array(often))], names=_names(_DONE))


def aligned(docs: DataFrame, json_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = RANGE) -> DataFrame:
    """One row per document: its token counts, groups and links (codes and how often each occurs).

    Texts of up to ``size`` characters are aligned where they are read.  Longer ones are cut into byte
    ranges that are dealt to all tasks; neighbouring fragments are composed level by level, ``FAN_IN``
    at a time, until each document has one.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    long = F.char_length("text") > size

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pair(json_path, piece_path)
        for batch in bounded(batches, "text", 1 << 20):
            yield _whole_texts(tokens, batch.column(0), text_column(batch, "text").to_pylist())

    piece = "key bigint, doc_id bigint, nth bigint, first bigint, low bigint, high bigint, text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pair(json_path, piece_path)
        for batch in bounded(batches, "text", 1 << 20):
            for doc_id, text, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                parts = [(key, doc_id, nth, *part) for nth, part in enumerate(byte_ranges(tokens, text, size))]
                for i in range(0, len(parts), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(c) if k != 1 else pa.array(c, pa.int64()) for k, c in enumerate(zip(*parts[i : i + 64]))], names=_names(piece))

    fragment = f"key bigint, doc_id bigint, nth bigint, {FIELDS}, codes array<bigint>, often array<bigint>"

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pair(json_path, piece_path)
        for batch in bounded(batches, "text", 1 << 20):
            found = []
            for key, doc_id, nth, first, low, high, text in zip(*(c.to_pylist() for c in batch.columns)):
                part, codes, often = range_fragment(tokens, text, first, low, high)
                found.append((key, doc_id, nth, *part, codes, often))
            yield _fragments(found, _names(fragment))

    ranges = rows.where(long).withColumn("key", F.monotonically_increasing_id()).mapInArrow(cut, piece)
    # Dealt anew, as all ranges of a document come from one task.
    parts = written(ranges.repartition("key", "nth").mapInArrow(one, fragment), "fragments")
    deepest = parts.agg(F.max("nth")).first()[0]
    levels = 1
    while deepest is not None and deepest >= FAN_IN ** levels:
        levels += 1

    def composed(table: pa.Table) -> tuple[Fragment, np.ndarray, np.ndarray]:
        table = table.sort_by("nth")
        found = compose_all([Fragment(*r) for r in zip(*(table.column(c).to_pylist() for c in Fragment._fields))])
        joined = lambda c: np.concatenate([np.zeros(0, np.int64), *[x.values.to_numpy() for x in table.column(c) if len(x)]])
        code, at = np.unique(joined("codes"), return_inverse=True)
        return found, code, np.bincount(at, joined("often"), len(code)).astype(np.int64)

    def compose_level(table: pa.Table) -> pa.Table:
        found, code, total = composed(table)
        first = table.column("key")[0].as_py(), table.column("doc_id")[0].as_py(), table.column("nth")[0].as_py() // FAN_IN
        return pa.Table.from_batches([_fragments([(*first, *found, code, total)], _names(fragment))])

    def finish(table: pa.Table) -> pa.Table:
        # The last level gives the digest at once: groups of several documents are never held together.
        whole, code, total = composed(table)
        doc_id = table.column("doc_id")[0].as_py()
        row = (doc_id, whole.n_a, whole.n_b, whole.cuts, _digest(groups_text(whole)), code, total) if whole.plain else (doc_id, 0, 0, 0, "", [], [])
        return pa.table([pa.array([c], t) for c, t in zip(row, _DONE_TYPES)], names=_names(_DONE))

    done = rows.where(~long).mapInArrow(short, _DONE)
    if deepest is None:
        return done
    for level in range(levels):
        last = level == levels - 1
        grouped = parts.withColumn("up", F.floor(F.col("nth") / FAN_IN)).groupBy("key", "up")
        parts = grouped.applyInArrow(finish if last else compose_level, _DONE if last else fragment)
    return done.unionAll(parts)


def _fragments(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    *plain, codes, often = zip(*rows)
    types = [pa.int64(), pa.int64(), pa.int64(), *_TYPES]
    return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(plain, types)], _lists(codes), _lists(often)], names=names)


def align(docs: DataFrame, json_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = RANGE) -> DataFrame:
    """How tokenizer A (byte-level, ``json_path``) and B (pieces, ``piece_path``) cut each whole text.

    A reads a space and the text, B the text, to which it adds the space itself; strings of special
    tokens are plain text.  Where tokens of both end, the text is cut into groups; two tokens that end
    together are a link.  Returns doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair of ids
    is the commonest of its B id in all documents, ties included), count_sum (how often the pairs of
    its links occur in all documents, summed) and groups_sha256 (of ``a1,a2|b1;a3|b2,b3``).

    Null and empty texts and texts which the tokens of either don't spell have no tokens: zeros and
    an empty digest.  Repeated rows are documents each, a null doc_id stays null, other columns are
    ignored.  A text without any space after another sign is tokenized in one go.
    """
    found = written(aligned(docs, json_path, piece_path, id_col, text_col, size), "aligned").withColumn("key", F.monotonically_increasing_id())
    links = found.select("key", F.explode_outer(F.arrays_zip("codes", "often")).alias("link")).select("key", "link.*")
    counts = links.where("codes is not null").groupBy("codes").agg(F.sum("often").alias("total"))
    counts = written(counts.withColumn("b", F.floor(F.col("codes") / HIGH)), "pairs")
    most = counts.groupBy("b").agg(F.max("total").alias("most"))
    known = written(counts.join(most, "b").select("codes", "total", (F.col("total") == F.col("most")).alias("best")), "counts")
    # Spark broadcasts the pairs by their size on storage, or else joins by the code, split where it is hot.
    judged = links.join(known, "codes", "left").groupBy("key").agg(
        F.coalesce(F.sum("often"), F.lit(0)).alias("n_links"),
        F.coalesce(F.sum(F.when(F.col("best"), F.col("often"))), F.lit(0)).alias("n_best"),
        F.coalesce(F.sum(F.col("often") * F.col("total")), F.lit(0)).alias("count_sum"),
    )
    return found.drop("codes", "often").join(judged, "key").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
