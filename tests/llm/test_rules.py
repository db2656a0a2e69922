"""Quality rules: counts against plain Python, verdicts on documents held out of training."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from headway.llm.rules import KEEP_AT, Rules, apply_rules, base_counts, features, fit

BIG = "/root/testdata/sf0.01"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _plainly(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab#\n \té漢\x0b\x1c\x85", max_size=80), st.lists(st.sampled_from(["a", "b", "\n"]), max_size=60).map(" ".join)), max_size=6))
def test_counts(texts):
    found = base_counts(pa.array(texts, pa.string()))
    assert [tuple(int(found[c][i]) for c in COUNTS) for i in range(len(texts))] == [_plainly(t) for t in texts]


def test_table(llm):
    docs, labels = (llm.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    rows = apply_rules(docs, labels).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(texts)
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    judged = []
    for r in rows:
        assert tuple(r[c] for c in COUNTS) == _plainly(texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= KEEP_AT) and 0 <= r["score"] <= 1
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        if r["held_out"] and r["doc_id"] in known and not r["base_failed"]:
            judged.append((known[r["doc_id"]], int(r["kept"])))
    assert len(judged) > 40 and sum(a == b for a, b in judged) / len(judged) > 0.97
    assert {a for a, _ in judged} == {0, 1}


def test_held_out_labels_change_nothing(llm):
    docs, labels = (llm.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    away = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(away, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = lambda frame: {r["doc_id"]: r["score"] for r in apply_rules(docs, frame).collect()}
    assert scores(labels) == scores(turned)


def test_score_does_not_depend_on_the_batch():
    texts = ["first text of some words", "", "x", "the second, längere text " * 30, None, "ab"]
    rng = np.random.default_rng(3)
    rows = features(pa.array(texts, pa.string()))
    model = fit(rows * 5, np.array([1, 0, 0, 1, 0, 1] * 5, float), np.ones(30), np.arange(30) % 5 == 1)
    model = Rules(model.weights + rng.normal(size=len(model.weights)), model.chance)
    together = model.score(pa.array(texts, pa.string()))
    alone = [model.score(pa.array([t], pa.string()))[0] for t in texts]
    assert together == pytest.approx(alone) and together[1] == pytest.approx(together[4])


def test_calibration_follows_the_shares():
    """Where the features say nothing, the score is the share of good rows."""
    same = features(pa.array(["one and the same text"]))[0]
    model = fit([same] * 400, np.array([i % 4 != 0 for i in range(400)], float), np.ones(400), np.arange(400) % 5 == 1)
    assert model.score(pa.array(["one and the same text"]))[0] == pytest.approx(0.75, abs=0.02)


def test_odd_rows(llm, odd_docs, no_docs):
    labels = llm.createDataFrame([(1, 1, 0), (7, 0, 1), (7, 1, 1), (8, None, None), (None, 0, 1), (9, 0, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = apply_rules(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    want = sorted((str(r["doc_id"]), _plainly(r["text"])) for r in odd_docs.collect())
    assert sorted((str(r["doc_id"]), tuple(r[c] for c in COUNTS)) for r in rows) == want
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    assert {r["score"] for r in apply_rules(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert apply_rules(no_docs, labels).count() == 0
