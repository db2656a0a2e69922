import re

import numpy as np
import pyarrow as pa

from headway.llm.words import SIGNS, WHITE, bounded, shingles, word_codes

TEXTS = ["", None, "A a\tB", "x" * 300_000, "é ß 漢字 É", " lead and trail ", "one", "a\x00b a b", "a-b_c 10x"] + [f"w{i} w{i + 1}" for i in range(500)] + ["longer text " * 60_000]


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_words_are_those_of_the_pattern():
    for pattern, table in (("[^\x20\x09-\x0D]+", WHITE), ("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", SIGNS)):
        codes, bounds = word_codes(pa.array(TEXTS, pa.string()), table)
        seen: dict[int, str] = {}
        for i, text in enumerate(TEXTS):
            words = re.findall(pattern, _lower(text or ""))
            own = codes[bounds[i] : bounds[i + 1]]
            assert len(own) == len(words)
            for code, word in zip(own.tolist(), words):
                assert seen.setdefault(code, word) == word
        assert len(set(seen.values())) == len(seen)


def test_codes_do_not_hang_on_the_batch():
    whole = pa.array(TEXTS, pa.string())
    codes, bounds = word_codes(whole)
    for at in (2, 4, 7):
        part, _ = word_codes(whole.slice(at, 1))
        assert np.array_equal(part, codes[bounds[at] : bounds[at + 1]])


def test_shingles():
    texts = pa.array(["a b c d e f", "a b", "", "f e d c b a", "a b c d e"])
    codes, bounds = shingles(*word_codes(texts), 5)
    assert np.diff(bounds).tolist() == [2, 1, 0, 2, 1]
    assert codes[0] == codes[-1]
    assert len(set(codes.tolist())) == 5


def test_bounded_slices_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS, pa.string())], names=["id", "text"])
    parts = list(bounded([batch], "text", 1000))
    assert sum(len(p) for p in parts) == len(TEXTS)
    assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p.column(1).to_pylist()) <= 1000 for p in parts)


def test_regular_words_have_codes_of_their_own():
    """Words that sums of powers can't tell apart, and words that differ in one byte at any place."""
    turn = {"a": "ab", "b": "ba"}
    word = "a"
    while len(word) < 1024:
        word = "".join(turn[c] for c in word)
    mirror = word.translate(str.maketrans("ab", "ba"))
    words = [word, mirror, word + "a", mirror + "a", *[word[:n] for n in range(1, 70)], *[mirror[:n] for n in range(1, 70)]]
    words += ["x" * i + "y" + "x" * (99 - i) for i in range(100)] + ["x" * n for n in range(1, 200)]
    codes, _ = word_codes(pa.array([" ".join(words)]))
    assert len(set(codes.tolist())) == len(set(words))
    again, _ = word_codes(pa.array(["pad " + w for w in words]))
    assert np.array_equal(again[1::2], codes)


def _mirrored():
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_regular_words_stay_apart_in_the_operators(llm):
    from headway.llm.backoff import backoff_scores
    from headway.llm.decontaminate import benchmark_hits
    from headway.llm.minhash import near_duplicates
    from headway.llm.passages import near_passages

    one, other = _mirrored()
    docs = llm.createDataFrame([(1, one, None), (2, other, None), (3, " ".join([one] * 60), None), (4, " ".join([other] * 60), None)], "doc_id bigint, text string, x int")
    assert all(r["kept"] for r in near_duplicates(docs).collect())
    hits = {r["doc_id"]: r["n_hit"] for r in benchmark_hits(docs, llm.createDataFrame([(1, one)], "item_id bigint, text string")).collect()}
    assert hits == {1: 1, 2: 0, 3: 60, 4: 0}
    assert near_passages(docs).count() == 0
    plain = llm.createDataFrame([(1, "c", None), (2, "d", None), (3, " ".join(["c"] * 60), None), (4, " ".join(["d"] * 60), None)], "doc_id bigint, text string, x int")
    scores = lambda df: sorted((r["doc_id"], round(r["log_score"], 9)) for r in backoff_scores(df).collect())
    assert scores(docs) == scores(plain)
