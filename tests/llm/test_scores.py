"""Classifiers, language-model scores and fingerprints."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest

from headway.llm.backoff import backoff_scores
from headway.llm.cotraining import cotrain, held_out, keep_quality, learn, score_quality
from headway.llm.logistic import Logistic
from headway.llm.order_minhash import edited_text, fingerprint, likeness, order_fingerprints
from headway.llm.toxicity import (
    GRAMMAR, INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT, Lexicon, Machine, aimed, cascade, insult, measures, score_toxicity, threat, weakened,
)
from headway.llm.words import SIGNS, word_codes

BIG = "/root/testdata/sf0.01"


def test_grammar_weighs_clauses():
    factors = Machine().factors
    assert factors([OTHER, INSULT]) == [0, 1]
    assert factors([TARGET, OTHER, INSULT])[-1] == 1.5
    assert factors([NEGATION, INSULT])[-1] == 0.4
    assert factors([REPORT, TARGET, NEGATION, INSULT])[-1] == pytest.approx(0.7 * 1.5 * 0.4)
    assert factors([NEGATION, OTHER, OTHER, OTHER, INSULT])[-1] == 1
    assert factors([]) == []


def test_threats_need_a_target():
    factors = Machine().factors
    assert factors([OTHER, THREAT, OTHER]) == [0, 0, 0]
    assert factors([THREAT, TARGET]) == [0, 1] and factors([TARGET, OTHER, THREAT]) == [0, 0, 1]
    assert factors([THREAT, *[OTHER] * 4, TARGET])[-1] == 0
    assert factors([NEGATION, THREAT, TARGET])[-1] == 0.4
    assert Machine(cascade(aimed(6), insult(1.5))).factors([THREAT, TARGET]) == [0, 0]


def _lexicon(words, weight):
    """Whole words as insults."""
    return Lexicon(word_codes(pa.array(words), SIGNS)[0], np.full(len(words), weight))


def test_equal_texts_measure_equally():
    clause = "you " + "word " * 30_000 + "she is a grobbel and not a grobbel " + "word " * 70_000 + "they grobbel kill him"
    lexicon = _lexicon(["grobbel"], 2.0)
    rows = [measures(pa.array([x for i in range(n) for x in ("filler " * (4001 * n + i), clause)]), lexicon, Machine()) for n in range(1, 8)]
    alike = np.vstack([r[1::2] for r in rows])
    assert (alike == alike[0]).all() and alike[0, 0] == pytest.approx(np.log1p(2 * 1.5 + 0.4 * 2 + 2 * 1.5 + 0.5))  # the second is 7 words from its target


@pytest.mark.parametrize("without", ["threat", "negation", "report", "target"])
def test_every_machine_helps(without):
    """Held-out ranking of clauses that only the whole cascade tells apart."""
    rng = np.random.default_rng(5)
    bad, plain = ["grobbel", "snarf", "wuzzle"], ["table", "river", "window", "paper"]
    pick = lambda words: words[rng.integers(len(words))]
    pairs = {
        "threat": (lambda: f"i kill you {pick(plain)}", lambda: f"i kill {pick(plain)} here"),
        "negation": (lambda: f"a {pick(bad)}", lambda: f"not a {pick(bad)}"),
        "report": (lambda: f"the {pick(bad)} of", lambda: f"according a {pick(bad)}"),
        "target": (lambda: f"you {pick(bad)} {pick(plain)}", lambda: f"{pick(plain)} {pick(bad)}"),
    }[without]
    parts = {"target": aimed(6), "insult": insult(1.5), "threat": threat(4), "negation": weakened(NEGATION, 3, 0.4), "report": weakened(REPORT, 40, 0.7)}
    lexicon = _lexicon(bad, 3.0)
    texts = [pairs[i % 2]() for i in range(200)]
    toxic = np.arange(200) % 2 == 0

    def ranked(grammar):
        x = measures(pa.array(texts), lexicon, Machine(grammar))[:, 0]
        wins = x[toxic][:, None] - x[~toxic][None, :]
        return (wins > 0).mean() + (wins == 0).mean() / 2

    left = cascade(*[m for name, m in parts.items() if name != without])
    assert ranked(GRAMMAR) == 1.0 and ranked(left) < 0.75


def test_held_out_toxicity(llm):
    docs, labels = (llm.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    judged = [(known[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert sum(a == b for a, b in judged) / len(judged) > 0.93


def test_labels_of_held_out_rows_change_nothing(llm):
    docs, labels = (llm.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = lambda frame: {r["doc_id"]: r["score"] for r in score_toxicity(docs, frame).collect()}
    assert scores(labels) == scores(turned)


def test_toxicity_of_odd_rows(llm, odd_docs, no_docs):
    labels = llm.createDataFrame([(1, 1, 0), (7, 1, 1), (8, None, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    rows = score_toxicity(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in score_toxicity(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert score_toxicity(no_docs, labels).count() == 0


def test_held_out_quality(llm):
    docs, labels = (llm.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    judged = [(known[r["doc_id"]], int(r["keep"])) for r in rows if r["held_out"] and r["doc_id"] in known]
    assert sum(a == b for a, b in judged) / len(judged) > 0.93
    kept = keep_quality(docs, labels)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["keep"]}


def test_quality_of_odd_rows(llm, odd_docs, no_docs):
    labels = llm.createDataFrame([(1, 1, 0), (7, 0, 1), (9, None, None)], "doc_id bigint, quality int, toxic int")
    assert score_quality(odd_docs, labels).count() == odd_docs.count()
    assert keep_quality(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert keep_quality(odd_docs, labels).columns == odd_docs.columns
    assert score_quality(no_docs, labels).count() == 0


def test_cotraining_hands_labels_over():
    rng = np.random.default_rng(2)
    y = (rng.random(2000) < 0.5).astype(float)
    a, b = (y[:, None] + rng.normal(0, s, (2000, 3)) for s in (0.4, 0.8))
    model = cotrain(a[:60], b[:60], y[:60], lambda f: f(a[60:1500], b[60:1500]))
    _, second, both = model.scores(a[1500:], b[1500:])
    alone = Logistic().fit(b[:60], y[:60]).score(b[1500:])
    right = lambda s: ((s >= 0.5) == y[1500:]).mean()
    assert right(both) > 0.95 and right(second) > right(alone) - 0.02
    assert len(model.handed) == 4 and all(2 * 144 <= n <= 1440 for given in model.handed for n in given)
    halves = cotrain(a[:60], b[:60], y[:60], lambda f: f(a[60:700], b[60:700]) + f(a[700:1500], b[700:1500]))
    assert np.allclose(halves.scores(a[1500:], b[1500:])[2], both)
    assert cotrain(a[:60], b[:60], y[:60], lambda f: np.zeros(0)).handed == ()


def test_all_free_rows_teach_both_ways(llm):
    docs, labels = (llm.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    model, views = learn(docs, labels)
    free = docs.join(labels, "doc_id", "left_anti").where(~held_out(docs["doc_id"])).count()
    assert views.count() == docs.count() and all(n >= 0.2 * free for given in model.handed for n in given)


def test_a_repeated_id_teaches_once(llm):
    docs = llm.createDataFrame([(1, f"text {i}", "en", "a", 6) for i in range(50)] + [(2, "#### |||", "en", "b", 8)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = llm.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    assert score_quality(docs, labels).count() == 51


def test_backoff_of_odd_rows(odd_docs, no_docs):
    rows = backoff_scores(odd_docs, order=3).collect()
    assert len(rows) == odd_docs.count()
    empty = [r for r in rows if not r["n_words"]]
    assert len(empty) == 4 and all(r["log_score"] == 0 and r["mean_log_score"] is None for r in empty)
    assert all(np.isfinite(r["log_score"]) for r in rows)
    assert backoff_scores(no_docs).count() == 0


def test_backoff_does_not_hang_on_the_blocks(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    scores = lambda n: {r["doc_id"]: round(r["log_score"], 6) for r in backoff_scores(docs, order=3, block_bytes=n).collect()}
    assert scores(20_000) == scores(1 << 30)


def test_fingerprints(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    texts = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    found = {r["doc_id"]: r for r in order_fingerprints(docs.repartition(5)).collect()}
    assert len(found) == len(texts)
    for (doc, text), (_, following) in zip(texts, texts[1:] + texts[:1]):
        edited, r = edited_text(text, following), found[doc]
        own, theirs, other = (fingerprint(t.encode()) for t in (text, edited, following))
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == own.astype(">u2").tobytes().hex() and r["edited_fingerprint"] == theirs.astype(">u2").tobytes().hex()
        assert (r["near_edited"], r["near_next"]) == (likeness(own, theirs), likeness(own, other))
    near, far = (np.mean([r[c] for r in found.values()]) for c in ("near_edited", "near_next"))
    assert near > 0.25 and near > far + 0.2


def test_fingerprints_heed_order():
    words = [f"word{i}" for i in range(300)]
    text, turned = " ".join(words).encode(), " ".join(words[150:] + words[:150]).encode()
    assert (fingerprint(text) == fingerprint(bytes(text))).all()
    assert likeness(fingerprint(text), fingerprint(turned)) < 0.9
    assert likeness(fingerprint(b""), fingerprint(b"")) == 1.0 and likeness(fingerprint(b""), fingerprint(b"a")) == 0.0


def test_long_texts_take_the_same_fingerprint(monkeypatch):
    import headway.llm.order_minhash as module

    text = "a long text, once more. ".encode() * 300
    wanted = fingerprint(text)
    order = module._in_order
    monkeypatch.setattr(module, "_in_order", lambda h, at: _slow(h, at))

    def _slow(h, at):
        high = h >> np.uint64(module.AT)
        turn = np.lexsort((at, high)) if at is not None else np.argsort(high, kind="stable")
        return high[turn], turn if at is None else at[turn]

    assert (fingerprint(text) == wanted).all()
    monkeypatch.setattr(module, "_in_order", order)


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    rows = order_fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r["fingerprint"] for r in rows if r["n_chars"] == 0} == {"0000" * 64}
    assert order_fingerprints(no_docs).count() == 0
    assert order_fingerprints(odd_docs.where("doc_id = 7")).first()["near_next"] == 1.0
