"""Cross-tokenizer alignment against whole-text tokenization, and the algebra of its fragments."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from headway.llm.alignment import HIGH, Fragment, Pair, align, aligned, byte_ranges, compose, compose_all, groups_text, range_fragment, ranged

JSON, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Plain words, don't they'll split?", "a  b   c\n d\n\ne \n", "  leading", "trailing  ", " ", "\n", "x\x1c y\x85 z　w", "<|endoftext|> <s> </s> <unk>",
    "é ß 漢字 \U0001f600‍", "has ▁ inside", "▁", "tab\tand\r\nreturn", "1234 5.6e7", "nul\x00 byte", "ﬁ ligature", "w" * 300 + " " + "ab" * 200,
]


@pytest.fixture(scope="module")
def tokens():
    return Pair(JSON, PIECES)


def _plainly(a, b, signs, text):
    """Token ids, groups and links of a whole text, straight from the two libraries."""
    if not text:
        return 0, 0, [], []
    found, pieces = a.encode(" " + text, add_special_tokens=False), b.encode(text)
    ids = found.ids
    of_a = [bytes(signs[c] for c in t) for t in found.tokens]
    of_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in pieces for p in [b.id_to_piece(i)]]
    stream = (" " + text).encode()
    if b"".join(of_a) != stream or b"".join(of_b) != stream:
        return 0, 0, [], []
    groups, links, x, y, i, j = [], [], len(of_a[0]), len(of_b[0]), 0, 0
    own_a, own_b = [ids[0]], [pieces[0]]
    while True:
        if x == y:
            groups.append(f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))}")
            links.append((own_a[-1], own_b[-1]))
            own_a, own_b = [], []
            if i + 1 == len(of_a):
                return len(of_a), len(of_b), groups, links
        if x <= y:
            i += 1
            x += len(of_a[i])
            own_a.append(ids[i])
            if own_b or x <= y:
                continue
        j += 1
        y += len(of_b[j])
        own_b.append(pieces[j])


@pytest.fixture(scope="module")
def plainly():
    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    return lambda text: _plainly(a, b, signs, text)


def _expected(plainly, rows):
    found = [(doc_id, *plainly(text or "")) for doc_id, text in rows]
    count = Counter(link for _, _, _, _, links in found for link in links)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(
        [(doc_id, n_a, n_b, len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
          hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for doc_id, n_a, n_b, groups, links in found],
        key=str,
    )


@pytest.mark.parametrize("size", [40, 1 << 15])
def test_rows_equal_whole_text_tokenization(llm, plainly, size):
    rows = list(enumerate(TEXTS)) + [(100, None), (101, ""), (None, TEXTS[0]), (0, TEXTS[0]), (102, " ".join(TEXTS * 3))]
    found = align(llm.createDataFrame(rows, "doc_id bigint, text string"), JSON, PIECES, size=size).collect()
    assert sorted([tuple(r) for r in found], key=str) == _expected(plainly, rows)


def test_documents_of_the_small_table(llm, sf_dir, plainly):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert sorted([tuple(r) for r in align(docs, JSON, PIECES, size=3000).collect()], key=str) == _expected(plainly, [tuple(r) for r in docs.collect()])


def test_odd_rows(llm, odd_docs, no_docs, plainly):
    found = align(odd_docs, JSON, PIECES)
    assert sorted([tuple(r) for r in found.collect()], key=str) == _expected(plainly, [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert align(no_docs, JSON, PIECES).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n'é漢12", min_size=1, max_size=120), st.integers(3, 40))
def test_any_ranges_compose_to_the_whole(tokens, plainly, text, size):
    parts = [range_fragment(tokens, run, first, low, high) for first, low, high, run in byte_ranges(tokens, text, size)]
    whole = compose_all([p[0] for p in parts])
    n_a, n_b, groups, links = plainly(text)
    assert (whole.plain, whole.n_a, whole.n_b, whole.cuts, whole.tail_a, whole.tail_b) == (True, n_a, n_b, len(groups), "", "")
    assert groups_text(whole) == ";".join(groups)
    assert sum((Counter(dict(zip(p[1].tolist(), p[2].tolist()))) for p in parts), Counter()) == Counter(b * HIGH + a for a, b in links)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=3, max_size=12), st.lists(st.integers(1, 4), min_size=3, max_size=12), st.lists(st.integers(0, 40), min_size=2, max_size=2))
def test_composition_is_associative(a_sizes, b_sizes, bounds):
    ends = lambda sizes: [sum(sizes[: i + 1]) for i in range(len(sizes))]
    low, high = sorted(bounds)
    part = lambda x, y: ranged(list(range(len(a_sizes))), list(range(len(b_sizes))), ends(a_sizes), ends(b_sizes), x, y)[0]
    x, y, z = part(0, low), part(low, high), part(high, 100)
    assert compose(compose(x, y), z) == compose(x, compose(y, z)) == part(0, 100)
    assert compose(Fragment(), x) == compose(x, Fragment()) == x


def test_ranges_are_open(tokens):
    text = "unbelievably " * 3
    parts = [range_fragment(tokens, run, first, low, high)[0] for first, low, high, run in byte_ranges(tokens, text, 17)]
    assert len(parts) > 2 and any(p.tail_a or p.tail_b for p in parts[:-1])


def test_a_full_store_is_emptied(tokens, plainly, monkeypatch):
    monkeypatch.setattr("headway.llm.alignment.KEPT", 30)
    own = Pair(JSON, PIECES)
    for text in ("one two three", "four five six seven eight nine ten", "one two three"):
        numbers = own.numbers(own.units(text))
        assert own.text_of(numbers) == ";".join(plainly(text)[2])
    assert len(own.groups) < 11


def test_the_last_composition_gives_the_digests(llm, plainly):
    """Whole documents' groups never leave the task that composes them, many documents in one batch."""
    rows = [(i, f"it's {i}, " + " ".join(f"unbelievable{j}" for j in range(60))) for i in range(3)] + [(3, "x" * 200), (4, "short")]
    found = aligned(llm.createDataFrame(rows, "doc_id bigint, text string"), JSON, PIECES, size=40)
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert sum("FlatMapGroupsInArrow" in line for line in plan) >= 2
    assert sum("MapInArrow" in line and "Groups" not in line for line in plan) == 1
    wanted = {i: hashlib.sha256(";".join(plainly(text)[2]).encode()).hexdigest() for i, text in rows}
    assert {r["doc_id"]: r["groups_sha256"] for r in found.collect()} == wanted
