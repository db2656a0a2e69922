"""Toxicity by a weighted finite-state grammar over clauses, with a lexicon learned from labels."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from headway.llm.logistic import Logistic
from headway.llm.shared import written
from headway.llm.words import SIGNS, U64, bounded, run_of_bytes, shingles, text_bytes, text_column, word_chunks, word_codes

# Function words of the grammar in English, German, French and Spanish.
TARGETS = (
    "you your yours yourself he she they him her them his their these those people everyone "
    "du dich dir dein deine ihr euch euer sie ihn ihm "
    "tu toi te ton ta tes vous votre vos lui elle eux ils elles "
    "tú ti tu tus usted ustedes vosotros él ella ellos ellas"
).split()
NEGATIONS = (
    "not no never neither nor none nobody cannot isn aren wasn weren don doesn didn won "
    "nicht kein keine keinen keiner nie niemals weder "
    "ne pas jamais aucun aucune ni "
    "no nunca jamás ningún ninguna ni tampoco"
).split()
REPORTS = (
    "said says say told tells claimed claims wrote writes reported reports quoted quotes according "
    "sagte sagt schrieb schreibt behauptet berichtet laut "
    "dit dirent écrit affirme affirmait selon "
    "dijo dice escribió afirma según"
).split()
THREATS = (
    "kill hurt destroy beat burn hunt die shoot stab "
    "töten schlagen verbrennen sterben "
    "tuer frapper brûler mourir "
    "matar golpear quemar morir"
).split()

#: Classes of words, and what the transducers write in their place.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, AIMED_INSULT, AIMED_THREAT, MATCH = range(9)
#: Weight of a matched threat; that of an insult comes from the lexicon.
THREAT_WEIGHT = 0.5
#: Bytes of the word beginnings that may enter the lexicon, besides whole words.
BEGINNINGS = range(3, 11)
#: Ends of a clause.
_CLAUSE_ENDS = np.zeros(256, bool)
_CLAUSE_ENDS[[ord(c) for c in ".!?;\n"]] = True


class Transducer(NamedTuple):
    """Reads a clause symbol by symbol and writes a symbol and a factor for each: (state, symbol) to (state, symbol, factor)."""

    start: object
    step: object

    def compose(self, other: Transducer) -> Transducer:
        """This machine's output is the other's input; their factors are multiplied."""

        def step(state, symbol):
            a, between, x = self.step(state[0], symbol)
            b, out, y = other.step(state[1], between)
            return (a, b), out, x * y

        return Transducer((self.start, other.start), step)


def aimed(reach: int) -> Transducer:
    """Insults and threats within ``reach`` words after a target are aimed; the state is what is left of it."""

    def step(left: int, symbol: int) -> tuple[int, int, float]:
        if symbol == TARGET:
            return reach, symbol, 1.0
        return max(left - 1, 0), {INSULT: AIMED_INSULT, THREAT: AIMED_THREAT}.get(symbol, symbol) if left else symbol, 1.0

    return Transducer(0, step)


def insult(factor: float) -> Transducer:
    """Insults match, aimed ones by ``factor``."""
    return Transducer(0, lambda state, symbol: (0, MATCH, factor if symbol == AIMED_INSULT else 1.0) if symbol in (INSULT, AIMED_INSULT) else (0, symbol, 1.0))


def threat(reach: int) -> Transducer:
    """A threat matches where it is aimed, or at the target within ``reach`` words after it; else it is nothing."""

    def step(left: int, symbol: int) -> tuple[int, int, float]:
        if symbol == AIMED_THREAT:
            return 0, MATCH, 1.0
        if symbol == THREAT:
            return reach, OTHER, 1.0
        if symbol == TARGET and left:
            return 0, MATCH, 1.0
        return max(left - 1, 0), symbol, 1.0

    return Transducer(0, step)


def weakened(kind: int, reach: int, factor: float) -> Transducer:
    """``factor`` for matches within ``reach`` words after a word of the class."""

    def step(left: int, symbol: int) -> tuple[int, int, float]:
        if symbol == kind:
            return reach, symbol, 1.0
        return max(left - 1, 0), symbol, factor if left and symbol == MATCH else 1.0

    return Transducer(0, step)


def cascade(*machines: Transducer) -> Transducer:
    """The machines one after the other."""
    out = machines[0]
    for machine in machines[1:]:
        out = out.compose(machine)
    return out


#: Who is meant, what matches, and what takes a match back.
GRAMMAR = cascade(aimed(6), insult(1.5), threat(4), weakened(NEGATION, 3, 0.4), weakened(REPORT, 40, 0.7))


class Machine:
    """The composed grammar, its states numbered as they are met and its steps kept in a table."""

    def __init__(self, grammar: Transducer = GRAMMAR):
        self.grammar, self.table, self.numbers, self.states = grammar, {}, {grammar.start: 0}, [grammar.start]

    def run(self, kinds: list[int], state: int = 0) -> tuple[list[float], int]:
        """The factor of each word, 0 for those that match nothing, and the state after the last one."""
        out = []
        for kind in kinds:
            move = self.table.get((state, kind))
            if move is None:
                after, symbol, factor = self.grammar.step(self.states[state], kind)
                if after not in self.numbers:
                    self.numbers[after] = len(self.states)
                    self.states.append(after)
                move = self.table[state, kind] = (self.numbers[after], factor if symbol == MATCH else 0.0)
            state, factor = move
            out.append(factor)
        return out, state

    def factors(self, kinds: list[int]) -> list[float]:
        return self.run(kinds)[0]


def _lowered(batch: pa.RecordBatch) -> pa.Array:
    column = text_column(batch, "text")
    return pc.utf8_lower(column.fill_null("") if column.null_count else column)


def _features(chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes of the words' beginnings and whole words, with the words that have them."""
    starts, ends = chunk[0], chunk[1]
    for n in BEGINNINGS:
        has = np.flatnonzero(ends - starts >= n)
        yield run_of_bytes(chunk, starts[has], starts[has] + n) + U64(n), has
    yield run_of_bytes(chunk, starts, ends), np.arange(len(starts))


class Lexicon:
    """Weights of feature codes, and the classes of the grammar's words."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.weights = codes[order], weights[order]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(codes >> U64(48)).astype(np.int64)] = True
        kinds: dict[int, int] = {}
        for kind, words in ((TARGET, TARGETS), (REPORT, REPORTS), (NEGATION, NEGATIONS), (THREAT, THREATS)):
            kinds |= {int(c): kind for c in word_codes(pa.array(words), SIGNS)[0]}
        self.kind_codes = np.array(sorted(kinds), U64)
        self.kinds = np.array([kinds[int(c)] for c in self.kind_codes])

    def _look(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.weights[at], 0.0)

    def words(self, chunk) -> tuple[np.ndarray, np.ndarray]:
        """Weight and class of each word of a chunk; a word of the grammar is no insult unless it is a threat."""
        weight = np.zeros(len(chunk[0]))
        if len(self.codes):
            for codes, words in _features(chunk):
                maybe = np.flatnonzero(self.maybe[(codes >> U64(48)).astype(np.int64)])
                weight[words[maybe]] = np.maximum(weight[words[maybe]], self._look(codes[maybe]))
        whole = run_of_bytes(chunk, chunk[0], chunk[1])
        at = np.minimum(np.searchsorted(self.kind_codes, whole), len(self.kind_codes) - 1)
        kind = np.where(self.kind_codes[at] == whole, self.kinds[at], OTHER)
        kind[(weight > 0) & ((kind == OTHER) | (kind == THREAT))] = INSULT
        weight[kind != INSULT] = THREAT_WEIGHT
        return weight, kind


MEASURES = 6
#: Clause scores are sums of whole parts of this size, so that no order of adding changes them.
PART = 2.0**-20


def measures(column: pa.Array, lexicon: Lexicon, machine: Machine) -> np.ndarray:
    """What the scores rest on, per row: words, and sum, number and largest of the clause scores.

    A clause that goes on after a chunk takes the machine's state along, so a row's measures are
    the same wherever the chunks are cut.
    """
    data, bounds = text_bytes(column)
    ends = np.flatnonzero(_CLAUSE_ENDS[data])
    out = np.zeros((len(column), MEASURES))

    def close(place, total: int, matches: int) -> None:
        if matches:
            r = place[0]
            out[r, 1] += total
            out[r, 2] += matches
            out[r, 3] = max(out[r, 3], total)
            out[r, 4] += 1

    place, state, total, matches = None, 0, 0, 0  # the clause that the last chunk left open
    for chunk in word_chunks(column, SIGNS):
        if not len(chunk[0]):
            continue
        weight, kind = lexicon.words(chunk)
        row = np.searchsorted(bounds, chunk[0], "right") - 1
        out[:, 0] += np.bincount(row, minlength=len(out))
        clause = np.searchsorted(ends, chunk[0])
        new = np.flatnonzero(np.diff(clause, prepend=-1) | np.diff(row, prepend=-1))
        hits = np.flatnonzero((kind == INSULT) | (kind == THREAT))
        # Clauses with a hit, the one left open and the one that may go on.
        for c in np.union1d(np.searchsorted(new, hits, "right") - 1, [0, len(new) - 1]):
            a, b = new[c], new[c + 1] if c + 1 < len(new) else len(kind)
            if place != (row[a], clause[a]):
                close(place, total, matches)
                place, state, total, matches = (row[a], clause[a]), 0, 0, 0
            factors, state = machine.run(kind[a:b].tolist(), state)
            score = np.rint(np.array(factors) * weight[a:b] / PART).astype(np.int64)
            total += int(score.sum())
            matches += int(np.count_nonzero(score))
    close(place, total, matches)
    out[:, [1, 3]] *= PART
    words = out[:, 0].copy()
    rate = out[:, 1] / np.maximum(words, 1)
    return np.column_stack([np.log1p(out[:, 1]), np.log1p(out[:, 2]), out[:, 3], np.log1p(out[:, 4]), np.log1p(100 * rate), np.log1p(words)])


def held_out(doc_id) -> F.Column:
    """Whether a document is kept apart from all learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = 6000, terms: int = 20000, grammar: Transducer = GRAMMAR) -> tuple[Lexicon, Logistic]:
    """Lexicon and scoring model from at most ``sample`` labelled rows of each class.

    The rows with the smallest hashes are taken, one of each group that shares its least word
    shingle, so that copies don't count as evidence.  One half gives the lexicon: the ``terms``
    words and word beginnings that speak most for the label, each in 2 % of a class's share or
    more.  The other half gives the weights of the clause measures.
    """
    usable = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id")
    chosen = [
        usable.where(F.col("toxic") == label).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct().orderBy(order, "doc_id").limit(sample)
        for label in (0, 1)
    ]
    rows = docs.join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            codes, bounds = shingles(*word_codes(text_column(batch, "text")), 5)
            low = [int(codes[a:b].min() >> U64(1)) if b > a else 0 for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low, pa.int64())], names=["doc_id", "text", "toxic", "half", "least"])

    rows = rows.select("doc_id", "text", "toxic", "half").mapInArrow(least, "doc_id bigint, text string, toxic int, half bigint, least bigint")
    rows = written(rows.dropDuplicates(["least", "toxic"]), "labelled")
    sizes = {r["toxic"]: r["n"] for r in rows.where("half = 0").groupBy("toxic").agg(F.count("*").alias("n")).collect()}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            column, toxic = _lowered(batch), np.array(batch.column(1))
            bounds = text_bytes(column)[1]
            found: list[np.ndarray] = []
            for chunk in word_chunks(column, SIGNS):
                row = np.searchsorted(bounds, chunk[0], "right") - 1
                for codes, words in _features(chunk):
                    found.append(np.unique(np.stack([codes, row[words].astype(U64)], 1), axis=0) if len(codes) else np.zeros((0, 2), U64))
            if not found:
                continue
            pairs = np.unique(np.concatenate(found), axis=0)
            label = toxic[pairs[:, 1].astype(np.int64)]
            codes, where = np.unique(pairs[:, 0], return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes.view(np.int64)), pa.array(np.bincount(where, label, len(codes)).astype(np.int64)), pa.array(np.bincount(where, 1 - label, len(codes)).astype(np.int64))],
                names=["code", "n1", "n0"],
            )

    many, few = sizes.get(0, 0), sizes.get(1, 0)
    tally = rows.where("half = 0").select("text", "toxic").mapInArrow(counts, "code bigint, n1 bigint, n0 bigint").groupBy("code").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    odds = F.log((F.col("n1") + 0.5) / (few + 1) / ((F.col("n0") + 0.5) / (many + 1)))
    best = tally.where(F.col("n1") >= max(3, 0.02 * few)).select("code", odds.alias("weight")).where("weight >= 1.5").orderBy(F.desc("weight"), "code").limit(terms).collect()
    lexicon = Lexicon(np.array([x[0] for x in best], np.int64).view(U64), np.minimum([x[1] for x in best], 6.0) if best else np.zeros(0))
    measured = _measured(rows.where("half = 1").select("doc_id", "text", "toxic"), lexicon, grammar, ("toxic int",)).collect()
    x = np.array([r["m"] for r in measured]).reshape(-1, MEASURES)
    y = np.array([r["toxic"] for r in measured], float)
    # The sample has another share of the label than the rows it stands for.
    share = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    weight = np.where(y == 1, share.get(1, 1) / max(y.sum(), 1), share.get(0, 1) / max((1 - y).sum(), 1))
    return lexicon, Logistic().fit(x, y, weight * len(y) / max(weight.sum(), 1e-9))


def _measured(docs: DataFrame, lexicon: Lexicon, grammar: Transducer, more: tuple[str, ...] = ()) -> DataFrame:
    """The rows (doc_id, text, ...) with their clause measures ``m``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(grammar)
        for batch in bounded(batches, "text", 1 << 20):
            m = measures(_lowered(batch), lexicon, machine)
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(list(m), pa.list_(pa.float64()))], names=["doc_id", *[x.split()[0] for x in more], "m"])

    return docs.mapInArrow(work, ", ".join(["doc_id bigint", *more, "m array<double>"]))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 6000, terms: int = 20000,
    grammar: Transducer = GRAMMAR,
) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score and predicted (score >= 0.5).

    A clause ends at . ! ? ; or a line break.  Its words are classed as insult (by the lexicon),
    threat, target, negation and report and go through a cascade of transducers, each reading what
    the one before wrote: targets aim insults and threats, insults match (more when aimed), threats
    match with a target only, negation and reported speech weaken matches.  A text is scored by its
    matched clauses; equal texts score equally.  Nothing but the text enters a score.  Null and empty
    texts have no clauses and get the score of such texts.  With labels of one kind only every
    score is their share, without any labels 0.5.  A null doc_id is never held out; other columns are ignored.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    lexicon, model = learn(plain, known, sample, terms, grammar)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(grammar)
        for batch in bounded(batches, "text", 1 << 20):
            score = model.score(measures(_lowered(batch), lexicon, machine)).round(12)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    return plain.mapInArrow(work, "doc_id bigint, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
