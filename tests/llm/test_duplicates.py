"""Near-duplicate documents and passages against brute force."""

import os
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import minhash, passages
from headway.llm.minhash import band_keys, circulant_signatures, near_duplicates
from headway.llm.passages import compact_windows, near_passages
from headway.llm.shared import components, respelled
from headway.llm.words import mix64, shingles, word_codes


def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0D]+", low)


def _set(text):
    w = _words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _groups(docs):
    sets = {d: _set(t) for d, t in docs.items()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by: dict[tuple, list] = {}
    for d, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(d)
    for x, y in {(x, y) for d in by.values() for x in d for y in d if x < y}:
        both = len(sets[x] & sets[y])
        if 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
            a, b = sorted((find(x), find(y)))
            root[b] = a
    return {d: (len(sets[d]), find(d)) for d in docs}


@pytest.fixture(scope="module")
def copies(llm):
    """One text in many versions, so that links run through some and others stay alone."""
    rng = np.random.default_rng(5)
    rows, number = [], 0
    for group, size in ((0, 120), (1, 30), (2, 5)):
        base = [f"g{group}w{i}" for i in range(120)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.integers(0, 7)):
                text[rng.integers(0, len(text))] = f"x{rng.integers(0, 10**9)}"
            rows.append((int(number * 7919 % 1009), " ".join(text)))
            number += 1
    rows += [(2000 + i, " ".join(f"{i}u{j}" for j in range(40)) + " one line that every text has in it") for i in range(60)]
    return llm.createDataFrame(rows, "doc_id bigint, text string")


def test_components(llm):
    links = [(i, i + 1) for i in range(100, 140)] + [(200 + i, 200) for i in range(50)] + [(7, 7), (None, 3), (3, 4)]
    found = {r["node"]: r["label"] for r in components(llm.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(100, 141)} == {100}
    assert {found[i] for i in range(200, 250)} == {200}
    assert (found[3], found[4], 7 in found) == (3, 3, False)


def test_groups_equal_brute_force(copies):
    docs = {r["doc_id"]: r["text"] for r in copies.collect()}
    found = near_duplicates(copies).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == _groups(docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_blocks_of_probes_are_bounded(llm, monkeypatch):
    """Different texts with one long passage in common share buckets, and nearly all are probes."""
    rng = np.random.default_rng(7)
    common, docs = [f"c{i}" for i in range(80)], {}
    for i in range(0, 160, 2):
        own = [f"f{x}" for x in rng.integers(0, 10**12, 24)]
        docs |= {i: " ".join(own + common), 159 - i: " ".join([*own[:10], "other", *own[11:], *common])}
    real = minhash._across

    def across(percent):
        work = real(percent)

        def held(table):
            assert table.num_rows <= 50
            return work(table)

        return held

    monkeypatch.setattr(minhash, "MEMBERS", 10)
    monkeypatch.setattr(minhash, "_across", across)
    found = near_duplicates(llm.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == _groups(docs)


def test_groups_on_a_whole_table(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = _groups({r["doc_id"]: r["text"] for r in docs.collect()})
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs).collect()} == wanted


def test_odd_rows(odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)]
    assert by[6][0][1:] == (5, False) and by[8][0] == (1, 7, False)
    assert {x[1:] for x in by[None]} == {(None, True)}
    assert sorted(x[1] for x in by[1]) == [-10] * 3 or sorted(x[1] for x in by[1]) == [1] * 3
    assert near_duplicates(no_docs).count() == 0


def test_signatures_estimate_similarity():
    codes = np.random.default_rng(1).integers(0, 2**63, 3000).astype(np.uint64)
    two = np.concatenate([codes[:2000], codes[500:2500]])  # similarity 0.6
    signatures = circulant_signatures(two, np.array([0, 2000, 4000]), 512)
    assert abs((signatures[0] == signatures[1]).mean() - 0.6) < 0.1
    assert (band_keys(signatures, 4)[0] == band_keys(circulant_signatures(codes[:2000], np.array([0, 2000]), 512), 4)[0]).all()


def test_compact_windows_hold_every_run():
    rng = np.random.default_rng(3)
    for n in (0, 4, 5, 17, 60):
        values = rng.integers(0, 12, n)
        _, left, center, right = compact_windows((values.astype(np.uint64) << np.uint64(40))[None, :], 5)
        for i in range(n):
            for j in range(i + 4, n):
                least = i + int(np.argmin(values[i : j + 1]))
                holds = (left <= i) & (i <= center) & (center <= j) & (j <= right)
                assert center[holds].tolist() == [least]


def test_passages(llm):
    rng = np.random.default_rng(9)
    fresh = lambda n: [f"f{x}" for x in rng.integers(0, 10**12, n)]
    shared, other = [f"s{i}" for i in range(60)], [f"o{i}" for i in range(40)]
    changed = list(shared)
    changed[30] = "changed"
    docs = [(1, fresh(80) + shared + fresh(5)), (2, shared + fresh(200)), (3, fresh(30) + changed), (4, fresh(90) + other), (5, other + fresh(90)), (6, shared * 3)]
    frame = llm.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id bigint, text string")
    rows = near_passages(frame).collect()
    assert {(r["doc_id"], r["class_doc_id"]) for r in rows} == {(2, 1), (3, 1), (6, 1)}
    exact = next(r for r in rows if r["doc_id"] == 2)
    assert (exact["start"], exact["end"], exact["class_start"], exact["class_end"], exact["similarity"]) == (0, 60, 80, 140, 1.0)
    assert all(r["similarity"] >= 0.75 for r in rows)


def test_all_equal_passages_of_a_table(llm, sf_dir):
    docs = {r["doc_id"]: _words(r["text"]) for r in llm.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    holders: dict[tuple, set] = {}
    for d, w in docs.items():
        for i in range(len(w) - 49):
            holders.setdefault(tuple(w[i : i + 50]), set()).add(d)
    wanted = {d for s in holders.values() if len(s) > 1 for d in s}
    rows = near_passages(llm.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    assert wanted <= {r["doc_id"] for r in rows} | {r["class_doc_id"] for r in rows}
    for r in rows:
        x, y = (_set(" ".join(docs[r[d]][r[a] : r[b]])) for d, a, b in (("doc_id", "start", "end"), ("class_doc_id", "class_start", "class_end")))
        assert abs(len(x & y) / len(x | y) - r["similarity"]) < 1e-9 and r["end"] - r["start"] >= 50


def test_passages_of_odd_rows(odd_docs, no_docs):
    rows = near_passages(odd_docs).collect()
    assert (6, 5) in {(r["doc_id"], r["class_doc_id"]) for r in rows}
    assert all(r["doc_id"] is not None for r in rows)
    assert near_passages(no_docs).count() == 0


def test_passages_with_inserted_words(llm):
    rng = np.random.default_rng(4)
    fresh = lambda n: [f"f{x}" for x in rng.integers(0, 10**12, n)]
    docs, pairs = [], set()
    for i in range(8):  # 76 of 96 shingles in common, either side being the longer one
        short = fresh(84)
        two = [short, short[:42] + fresh(12) + short[42:]]
        docs += [(2 * i, fresh(70) + two[i % 2]), (2 * i + 1, two[1 - i % 2] + fresh(70))]
        pairs.add((2 * i + 1, 2 * i))
    rows = near_passages(llm.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id bigint, text string")).collect()
    assert {(r["doc_id"], r["class_doc_id"]) for r in rows} == pairs
    assert all(abs(r["similarity"] - 76 / 96) < 1e-9 for r in rows)


def test_passages_behind_other_documents_of_their_buckets(llm):
    """Each least shingle of a passage also lies in another number of earlier documents."""
    rng = np.random.default_rng(8)
    fresh = lambda n: [f"f{x}" for x in rng.integers(0, 10**12, n)]
    salts = mix64(np.arange(1, 6, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    least = lambda words: [int(np.argmin(mix64(shingles(*word_codes(pa.array([" ".join(words)])), 5)[0] ^ s))) for s in salts]
    passage = fresh(50)
    while len(set(least(passage))) < 5:
        passage = fresh(50)
    docs = []
    for f, at in enumerate(least(passage)):
        for _ in range(f):
            text = []
            while not text or least(text)[f] != 20:
                text = fresh(20) + passage[at : at + 5] + fresh(25)
            docs.append(text)
    docs += [fresh(60) + passage, passage + fresh(60)]
    rows = near_passages(llm.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id bigint, text string")).collect()
    assert [(r["doc_id"], r["class_doc_id"], r["start"], r["end"], r["similarity"]) for r in rows] == [(11, 10, 0, 50, 1.0)]


def test_passages_near_a_member_only(llm):
    """Chains of edited copies: the ends are too far apart, the middle is in a class by then."""
    rng = np.random.default_rng(12)
    docs, wanted = [], set()
    for i in range(12):
        base, fresh = ([f"f{x}" for x in rng.integers(0, 10**12, n)] for n in (100, 4))
        edited = lambda *at: [fresh[at.index(j)] + str(j) if j in at else w for j, w in enumerate(base)]
        first, middle, end = base, edited(20, 60), [f"e{j}" if j in (40, 80) else w for j, w in enumerate(edited(20, 60))]
        order = (first, middle, end) if i % 2 else (first, end, middle)
        docs += [(3 * i + j, " ".join(w)) for j, w in enumerate(order)]
        wanted |= {(3 * i + 1, 3 * i), (3 * i + 2, 3 * i + 1)} if i % 2 else {(3 * i + 2, 3 * i), (3 * i + 2, 3 * i + 1)}
    rows = near_passages(llm.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {(r["doc_id"], r["class_doc_id"]) for r in rows} == wanted


def test_a_node_of_many_links_is_split(llm):
    star = llm.range(1, 40_000, 1, 16).select(F.lit(0).cast("bigint").alias("a"), F.col("id").alias("b"))
    rest = llm.range(50_000, 60_000, 2, 4).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    links = star.unionAll(rest)
    labels = {r["node"]: r["label"] for r in components(links).collect()}
    assert labels == {n: 0 for n in range(40_000)} | {n: n - n % 2 for n in range(50_000, 60_000)}
    grouped = respelled(links.groupBy("a").agg(F.min("b").alias("m")), "a")
    names = ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold", "adaptive.advisoryPartitionSizeInBytes", "adaptive.skewJoin.skewedPartitionThresholdInBytes", "adaptive.skewJoin.skewedPartitionFactor")
    before = {f"spark.sql.{n}": llm.conf.get(f"spark.sql.{n}", None) for n in names}
    try:
        for name, value in zip(before, ("-1", "-1", "10k", "10k", "1.5")):
            llm.conf.set(name, value)
        joined = links.join(grouped, "a")
        assert len(joined.collect()) == links.count()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            llm.conf.unset(name) if value is None else llm.conf.set(name, value)


def test_passages_keep_no_table_but_the_passages(llm, monkeypatch):
    tables, table = [], passages.written
    monkeypatch.setattr(passages, "written", lambda df, name: tables.append((name, table(df, name))) or tables[-1][1])
    same = " ".join(f"w{i}" for i in range(80))
    docs = llm.createDataFrame([(i, f"a{i} b{i} c{i} {same} d{i} e{i}") for i in range(4)], "doc_id bigint, text string")
    found = passages.near_passages(docs)
    assert {(r["doc_id"], r["class_doc_id"]) for r in found.collect()} == {(i, 0) for i in range(1, 4)}
    assert {name for name, df in tables if os.path.exists(df.folder.removeprefix("file:"))} == {"passages"}


def test_last_pass_meets_in_parts(llm, monkeypatch):
    """Documents far apart that share two passages with different classes: their pairs are met in parts, all of them once."""
    rng = np.random.default_rng(21)
    base, docs = [f"b{i}" for i in range(100)], []
    for d in range(24):
        text = list(base)
        for at in rng.choice(100, 3, False):
            text[at] = f"x{rng.integers(0, 10**9)}"
        docs.append((d, " ".join(text)))
    frame = llm.createDataFrame(docs, "doc_id bigint, text string")
    ask = lambda: sorted(tuple(r) for r in near_passages(frame).collect())
    monkeypatch.setattr(passages, "AT_ONCE", 1000)
    whole, tables, table = ask(), [], passages.written
    monkeypatch.setattr(passages, "written", lambda df, name: tables.append((name, table(df, name))) or tables[-1][1])
    counts, drop = [], passages.dropped
    monkeypatch.setattr(passages, "dropped", lambda *t: counts.extend(x.select("doc_id", "leader").collect() for x in t for n, y in tables if y is x and n == "last_pairs") or drop(*t))
    monkeypatch.setattr(passages, "AT_ONCE", 0.25)
    assert ask() == whole and len(whole) > 24
    assert sum(map(bool, counts)) > 1 and len({tuple(r) for x in counts for r in x}) == sum(map(len, counts))
    assert {name for name, df in tables if os.path.exists(df.folder.removeprefix("file:"))} == {"passages"}


def test_windows_of_one_word_over_and_over_meet_as_one(llm, monkeypatch):
    """A text that repeats a word has a window of the same bucket at many places: the last pass takes them together."""
    rows, table = [], passages.written

    def written(df, name):
        made = table(df, name)
        if name == "run_windows":
            rows.extend((r["key"], r["doc_id"], tuple(r["classes"])) for r in made.collect())
        return made

    monkeypatch.setattr(passages, "written", written)
    some = ("the", "and", "of", "to", "in", "is", "on", "at")
    texts = [f"{x} " * 90 for x in some] + [f"{x} " * 45 + f"{y} " * 45 + f"end{x}{y}" for x in some for y in some if x < y]
    near_passages(llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert len(set(rows)) == len(rows) and len(rows) > 40


def test_cells_find_what_pairs_find():
    """Texts held against many at once give what each pair gives, whatever is told apart beforehand."""
    rng, texts = np.random.default_rng(31), []
    for base in ([f"s{i}" for i in range(150)], ["the"] * 70 + [f"t{i}" for i in range(60)], [f"u{i % 40}" for i in range(160)]):
        for _ in range(9):
            text = list(base)
            for at in rng.choice(len(text), rng.integers(0, 12), False):
                text[at : at + 1] = [f"x{x}" for x in rng.integers(0, 10**9, rng.integers(0, 4))]
            texts.append(" ".join(text[rng.integers(0, 60) :]))
    texts += ["", "two words", texts[0]]
    cell = passages._Cell(list(range(len(texts))), [pa.array(texts[:5]), pa.array(texts[5:])], 5)
    codes = [shingles(*word_codes(pa.array([t])), 5)[0] for t in texts]
    salts = mix64(np.arange(1, 6, dtype=np.uint64))[:, None]
    wanted, got = {}, {}
    for i, own in enumerate(codes):
        at = passages._packed(*compact_windows(mix64(own ^ salts), 46)) if len(own) >= 46 else np.zeros(0, np.int64)
        others = [j for j in range(len(texts)) if j != i]
        wanted |= {(i, j): x for j in others if (x := passages.passages_of(own, codes[j], at, 46, 75, 2))}
        got |= {(i, others[k]): x for k, x in cell.passages(i, others, [at] * len(others), 46, 75, 2) if x}
    assert got == wanted and 50 < len(got) < 600


def test_open_places_are_where_shingles_have_several_classes(llm):
    rng = np.random.default_rng(17)
    base, docs = [f"b{i}" for i in range(300)], []
    for d in range(20):
        at = int(rng.integers(0, 240))
        text = [*(f"f{x}" for x in rng.integers(0, 10**12, 40)), *base[at : at + 60], *(f"f{x}" for x in rng.integers(0, 10**12, 9))]
        docs.append((d, " ".join(text), [(38, 90, 0)] if d % 3 == 0 else None))
    frame = llm.createDataFrame(docs, "doc_id bigint, text string, spans array<struct<start: bigint, end: bigint, class_doc_id: bigint>>")
    holders: dict[int, set] = {}
    codes = [shingles(*word_codes(pa.array([t])), 5)[0].tolist() for _, t, _ in docs]
    for (d, _, spans), own in zip(docs, codes):
        for i, code in enumerate(own):
            holders.setdefault(code, set()).add(min([d, *(c for a, b, c in spans or () if a <= i < b - 4)]))
    bits = {code % passages.SLOTS for code, x in holders.items() if len(x) > 1}
    wanted = {}
    for (d, _, _), own in zip(docs, codes):
        change = np.diff(np.concatenate([[0], passages.alike_places(np.array([c % passages.SLOTS in bits for c in own]), 46, 75), [0]]))
        if change.any():
            wanted[d] = list(zip(np.flatnonzero(change > 0).tolist(), np.flatnonzero(change < 0).tolist()))
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in passages._open_places(frame, 5, 46, 75).collect()}
    assert got == wanted and len(got) > 5
