from __future__ import annotations

import pytest

from headway.llm.shared import set_batches


@pytest.fixture(scope="session")
def llm(spark):
    """The session with small batches, so that a test has several."""
    return set_batches(spark, 7)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, score string, label int, removed_lines int"


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Rows no operator may stumble over: nulls, empty and blank and long texts, ties, clashing names."""
    words = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"v{i % 977}" for i in range(120_000))
    rows = [
        (1, words, "en", "a"), (1, words, "en", "a"), (1, "other text under the same id", None, "b"),
        (2, None, None, None), (3, "", "en", "a"), (4, " \t\n \r\n", "de", "a"), (None, words, "en", "a"), (None, None, None, None),
        (5, long, "en", "b"), (6, long + " end", "fr", "b"), (7, "two words", "en", "a"), (8, "Two  WORDS", "en", "a"),
        (9, "é ß 漢字 <|endoftext|>  x y\x1cz", "en", "a"), (-10, words.upper() + "\nsame line\nsame line", "en", "a"),
    ]
    return llm.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, "k", "s", 1, 2) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], DOCS)
