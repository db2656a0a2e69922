"""Archive, decontamination, line dedup, packing and the pipeline."""

import hashlib
import os
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import lines, packing, warc
from headway.llm.decontaminate import WuManber, benchmark_hits
from headway.llm.lines import drop_repeated_lines, line_repeats
from headway.llm.packing import Index, fill_windows, pack
from headway.llm.queries import packed
from headway.llm.shared import CLEANUP, shared_folder, written
from headway.llm.words import SIGNS, word_codes


def test_archive_round_trip(llm):
    body = "<p>" + "é" * 80 + "</p>"
    rows = [(3, "http://a\nb", body, 1), (1, "http://b", body, 1), (2, None, "small", 1), (4, "u", "small", 1), (5, "u", None, 1), (None, "n", body, 1), (3, "again", body, 1)]
    pages = llm.createDataFrame(rows, "page_id bigint, url string, html string, digest int")
    folder = shared_folder(llm, "archive")
    warc.write_archive(pages, folder)
    assert llm.read.parquet(f"{folder}/payloads").count() == 3
    records = warc.read_archive(llm, folder).collect()
    assert len(records) == len(rows)
    for r in records:
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert rest[: int(fields["Content-Length"])] == (b"" if fields["WARC-Type"] == "revisit" else bytes(r["payload"])) and rest.endswith(b"\r\n\r\n")
        assert fields["WARC-Date"] == warc.DATE
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(bytes(r["payload"])).hexdigest()
    table = sorted((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.record_table(warc.read_archive(llm, folder)).collect())
    n = len(body.encode())
    assert table == [(0, n, "revisit", 1), (1, n, "response", None), (2, 5, "response", None), (3, n, "revisit", 1), (3, n, "revisit", 1), (4, 5, "response", None), (5, 0, "response", None)]


def test_records_are_parsed_from_buckets(llm):
    body, other = "<p>" + "é" * 80 + "</p>", "a\r\n\r\nb" * 30
    rows = [(3, "http://ü\nb", body), (1, "http://b", body), (2, None, "small"), (4, "u", "small"), (5, "u", None), (None, "n", body), (3, "again", body), (6, "u", other), (7, "u", other), (8, "u", "\r\n\r\n")]
    pages = llm.createDataFrame(rows, "page_id bigint, url string, html string")
    folder, plain = shared_folder(llm, "archive"), shared_folder(llm, "archive")
    warc.write_archive(pages, folder, buckets=8)
    warc.write_archive(pages, plain)
    before = llm.conf.get("spark.sql.autoBroadcastJoinThreshold")
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = warc.read_records(llm, folder, 8)._jdf.queryExecution().executedPlan().toString()
    finally:
        llm.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in plan
    found = [sorted((r["page_id"] or 0, r["header"], bytes(r["record"])) for r in df.collect()) for df in (warc.read_records(llm, folder, 8), warc.read_archive(llm, folder, 8), warc.read_archive(llm, plain))]
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    table = sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.record_table(warc.read_records(llm, folder, 8)).collect())
    first = {body: 1, other: 6}
    wanted = []
    for page, _, html in rows:
        data = (html or "").encode()
        again = html in first and page != first[html]
        wanted.append((page or 0, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    assert table == sorted(wanted)
    cut = warc.read_records(llm, folder, 8).withColumn("record", F.expr("substr(record, 1, octet_length(record) - 1)"))
    with pytest.raises(Exception, match="unsound record"):
        warc.record_table(cut).collect()
    empty = shared_folder(llm, "archive")
    warc.write_archive(pages.limit(0), empty, buckets=8)
    assert warc.record_table(warc.read_records(llm, empty, 8)).count() == 0


def test_damaged_archive_fails(llm):
    pages = llm.createDataFrame([(1, "u", "x" * 200)], "page_id bigint, url string, html string")
    folder, other = shared_folder(llm, "archive"), shared_folder(llm, "archive")
    warc.write_archive(pages, folder)
    llm.read.parquet(f"{folder}/payloads").withColumn("payload", F.encode(F.lit("y"), "UTF-8")).write.parquet(f"{other}/payloads")
    llm.read.parquet(f"{folder}/headers").write.parquet(f"{other}/headers")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(llm, other).collect()


def test_wu_manber_finds_what_brute_force_finds():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3, 5000).astype(np.uint64)
    bounds = np.array([0, 0, 1, 700, 700, 4000, 5000])
    for m in (1, 2, 3, 10):
        patterns = np.unique(np.stack([words[i : i + m] for i in rng.integers(0, 4900, 40)]), axis=0)
        start, which = WuManber(patterns).find(words, bounds)
        wanted = {
            (i, p) for a, b in zip(bounds, bounds[1:]) for i in range(a, b - m + 1) for p in range(len(patterns)) if (words[i : i + m] == patterns[p]).all()
        }
        assert set(zip(start.tolist(), which.tolist())) == wanted and len(start) == len(wanted)


def test_passes_give_the_same(llm, sf_dir):
    docs, benchmark = (llm.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    once = benchmark_hits(docs, benchmark).drop("spans")
    thrice = benchmark_hits(docs, benchmark, pass_bytes=4000).drop("spans")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, thrice.collect()))


def test_hits_of_odd_rows(llm, odd_docs, no_docs):
    items = [(10, "two words"), (9, "TWO words"), (8, None), (7, "..."), (None, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13")]
    benchmark = llm.createDataFrame(items, "item_id bigint, text string")
    rows = benchmark_hits(odd_docs, benchmark).collect()
    assert len(rows) == odd_docs.count()
    seven = next(r for r in rows if r["doc_id"] == 7)
    assert (seven["n_words"], seven["n_hit"], seven["n_items"], seven["items_sha256"]) == (2, 2, 2, hashlib.sha256(b"10,9").hexdigest())
    assert {(r["n_hit"], r["n_items"]) for r in rows if r["doc_id"] == -10} == {(11, 1)}
    assert not any(r["contaminated"] for r in benchmark_hits(odd_docs, benchmark.limit(0)).collect())
    assert benchmark_hits(no_docs, benchmark).count() == 0


def test_lines_of_odd_rows(odd_docs, no_docs):
    rows = line_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    cut = drop_repeated_lines(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert texts[2] is None and texts[7] == "two words" and texts[8] == "" and texts[6] == ""
    assert texts[-10] == "same line"  # its first line is that of the rows that share an id
    assert line_repeats(no_docs).count() == 0 and drop_repeated_lines(no_docs).count() == 0


def test_similar_lines(llm):
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(50)]
    rows = []
    for d in range(60):
        text = list(base)
        for _ in range(rng.integers(0, 4)):
            text[rng.integers(0, 50)] = f"x{rng.integers(0, 10**9)}"
        rows.append((d, " ".join(text) + "\nown line " + " ".join(f"o{d}x{i}" for i in range(8))))
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    sets = [({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) for w in (t.split("\n")[0].split(" ") for _, t in rows)]
    wanted = {d for d in range(60) if any(100 * len(sets[d] & sets[e]) >= 75 * len(sets[d] | sets[e]) for e in range(d))}
    assert {r["doc_id"]: r["removed_lines"] for r in line_repeats(docs).collect()} == {d: [0] if d in wanted else [] for d in range(60)}


def test_sets_are_worked_out_twice_only(llm, monkeypatch):
    """Once for all lines and once for those that meet others; a class never comes together by its set."""
    made, tables = [], []
    shingles, table = lines._with_shingles, lines.written
    monkeypatch.setattr(lines, "_with_shingles", lambda *a: made.append(1) or shingles(*a))
    monkeypatch.setattr(lines, "written", lambda df, name: tables.append((name, df)) or table(df, name))
    same = "one two three four five six\n\n \t \n one\tTWO  three four\rfive six"
    docs = llm.createDataFrame([(i, same) for i in range(20)], "doc_id bigint, text string")
    removed = {r["doc_id"]: r["removed_lines"] for r in line_repeats(docs).collect()}
    assert removed == {i: [0, 3] if i else [3] for i in range(20)}
    assert len(made) == 2
    plans = [df._jdf.queryExecution().executedPlan().toString() for _, df in tables]
    assert not any("Join" in line and "h1" in line for plan in plans for line in plan.split("\n"))


def test_a_written_table_leaves_no_shuffle_files(llm):
    env = llm.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def left():
        return {f.getName() for f in _scala_list(env.blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}

    def _scala_list(seq):
        return [seq.apply(i) for i in range(seq.size())]

    before, conf = left(), llm.conf.get(CLEANUP, None)
    groups = written(llm.range(1000).groupBy((F.col("id") % 7).alias("a")).agg(F.count("*").alias("n")), "groups")
    for _ in range(100):
        if left() <= before:
            break
        time.sleep(0.1)
    assert left() <= before
    assert llm.conf.get(CLEANUP, None) == conf
    assert groups.count() == 7 and sum(r["n"] for r in groups.collect()) == 1000


def test_lines_keep_no_table_that_is_read_no_more(llm, monkeypatch):
    tables, table = [], lines.written
    monkeypatch.setattr(lines, "written", lambda df, name: tables.append((name, table(df, name))) or tables[-1][1])
    words = [f"w{i}" for i in range(30)]
    docs = llm.createDataFrame([(i, " ".join(words[:-1] + [f"x{i}"]) + "\nsame line of six words here") for i in range(20)], "doc_id bigint, text string")
    removed = {r["doc_id"]: r["removed_lines"] for r in line_repeats(docs).collect()}
    assert removed == {i: [0, 1] if i else [] for i in range(20)}
    assert {name for name, df in tables if os.path.exists(df.folder.removeprefix("file:"))} == {"shared_ids", "repeated_lines"}


def test_unlike_lines_of_a_bucket_make_no_pairs(llm, monkeypatch):
    """Edited copies too far from each other share most of their buckets; few of their pairs may become rows."""
    rng, made, candidates = np.random.default_rng(3), [], lines._candidates
    monkeypatch.setattr(lines, "_candidates", lambda *a: made.append(candidates(*a).count()) or candidates(*a))
    base, rows = [f"w{i}" for i in range(120)], []
    for d in range(60):
        text = list(rows[-1][1]) if d % 20 == 19 else list(base)
        for at in rng.choice(120, 1 if d % 20 == 19 else 5, False):
            text[at] = f"x{rng.integers(0, 10**9)}"
        rows.append((d, text))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, w in rows]
    wanted = {d for d in range(60) if any(100 * len(sets[d] & sets[e]) >= 75 * len(sets[d] | sets[e]) for e in range(d))}
    docs = llm.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id bigint, text string")
    assert {r["doc_id"] for r in line_repeats(docs).collect() if r["removed_lines"]} == wanted
    assert len(wanted) >= 3 and sum(made) <= 60


def _ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def _check_pieces(pieces, docs, window=1024):
    by: dict = {}
    rows: dict = {}
    for r in pieces:
        by.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        rows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for (doc, size), own in by.items():
        texts = [_ids(t) for d, t in docs if d == doc and len(_ids(t)) == size]
        at = 0
        for r in sorted(own, key=lambda r: (r["start"], r["ids_crc32"]))[:: len(texts)]:
            assert r["start"] == at
            at += r["length"]
            assert r["ids_crc32"] in [zlib.crc32(t[r["start"] : at].tobytes()) for t in texts]
        assert at == size
    for own in rows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    return rows


def test_packing_of_a_table(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    pieces = packed(docs).collect()
    assert {r["doc_id"] for r in pieces} == {d for d, _ in texts}
    rows = _check_pieces(pieces, texts)
    assert sum(len(_ids(t)) for _, t in texts) / (1024 * len(rows)) > 0.97


def test_packing_of_odd_rows(llm, odd_docs, no_docs):
    odd = odd_docs.where("doc_id is null or doc_id not in (1, 5, 6)").dropDuplicates(["doc_id"])
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    _check_pieces(packed(odd).collect(), texts)
    assert packed(odd_docs).select("doc_id").distinct().count() == odd_docs.select("doc_id").distinct().count()
    assert packed(no_docs).count() == 0


def test_packing_with_ids(llm):
    import public_tokenizers as P

    texts = ["one\n\ntwo", " lead", "trail ", "a  b", "tab\tx", "it's 10x!", "É ß y", "<|endoftext|> z", "\n", "a\nb c\n"]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pack(docs, P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {i: _ids(t).tolist() for i, t in enumerate(texts)}


def test_plain_texts_are_encoded_whole(monkeypatch):
    import public_tokenizers as P

    tokens = packing.Tokens(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    calls, ranks = [], tokens.ranks

    class Counted:
        def encode_ordinary(self, text):
            calls.append(text)
            return ranks.encode_ordinary(text)

    tokens.ranks = Counted()
    plain = ["it's one line of 12 words", "é ß 漢字\nline. two", "a\u200bb c", "x" * 3000 + " y"]
    odd = ["", " a", "a ", "a  b", "a\n\nb", "a\tb", "a\x1cb", "a\xa0b", "a\u3000b", "a\x85b", "a\r\nb", "x <|endoftext|>"]
    for text in plain + odd:
        assert tokens.encode(text) + b"\0\0\0\0" == _ids(text).tobytes()
    assert calls == plain


def test_columns_are_encoded_without_looking_ahead():
    import public_tokenizers as P
    import pyarrow as pa

    tokens = packing.Tokens(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rng = np.random.default_rng(7)
    signs = [*"ab1'.é漢", *"  \n\n", *"\t\v\f\r\x1c\x1f\x85\xa0\u1680\u2000\u200a\u200b\u2028\u2029\u202f\u205f\u3000"]
    texts = ["".join(signs[i] for i in rng.integers(0, n, rng.integers(0, 9))) for n in [9, 11, len(signs)] for _ in range(500)]
    texts += ["it's a\nplain text", "x<|endoftext|>y", "a \n b"]
    wanted = [tokens.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in tokens.encode_all(pa.array(texts, pa.string()))] == wanted
    assert "(?" in P.PATTERN and "(?" not in tokens.ranks._pat_str


def test_neighbours_come_together():
    rng = np.random.default_rng(6)
    topics = [rng.integers(1000 * t, 1000 * t + 50, (10, 100)) for t in range(1, 6)]
    docs = [(t, topics[t][i].astype("<u4").tobytes()) for i in range(10) for t in range(5)]
    rows = fill_windows([d for _, d in docs], 500)
    assert sum(n for row in rows for _, _, n in row) == 5000
    mixed = [len({docs[d][0] for d, _, _ in row}) for row in rows]
    assert sum(mixed) <= 2 * len(rows)


def test_neighbours_share_any_term():
    """The seed's neighbour has only its commoner terms; the other documents none of them."""
    seed = np.arange(100)
    rows = [seed, np.arange(1000, 1100), np.arange(40, 140), *[np.arange(2000 + 100 * i, 2100 + 100 * i) for i in range(5)], np.arange(40, 80)]
    index = Index([r.astype("<u4").tobytes() for r in rows])
    index.unused[0] = False
    assert index.neighbours(0)[:2].tolist() == [2, 8]
    index.unused[3:8] = False  # the used are cleared out, the order of the others stays
    assert index.neighbours(0).tolist() == [2, 8, 1] and len(index.doc) == 240


def test_rows_without_an_id_of_their_own(llm, sf_dir):
    item = llm.read.parquet(f"{sf_dir}/benchmark.parquet").where("length(text) > 200").first()["text"]
    clean, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    rows = [(None, item), (None, clean), (None, clean), (1, item), (1, clean), (2, other), (2, other), (3, other), (4, " "), (4, " "), (5, None)]
    docs = llm.createDataFrame(rows, "doc_id bigint, text string")
    left = lambda stage: sorted(((r["doc_id"], r["text"]) for r in stage(llm, docs, sf_dir).collect()), key=str)
    assert left(corpus_pipeline.decontamination) == sorted([r for r in rows if r[1] != item], key=str)
    kept = left(corpus_pipeline.near_dedup)
    assert sorted(str(t) for _, t in kept) == sorted(map(str, [item, clean, other, " ", " ", None]))


def test_every_stage_keeps_the_columns(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        after[name] = {r["doc_id"] for r in out.collect()}
    everything = {r["doc_id"] for r in docs.collect()}
    assert after["line_dedup"] == everything
    assert 0 < len(everything - after["decontamination"]) < len(everything) / 4
    assert 0 < len(everything - after["near_dedup"]) < len(everything) / 4


def test_pipeline(llm, sf_dir):
    pieces = corpus_pipeline.run(llm, sf_dir)
    assert pieces.count() > 0 and pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").isEmpty()


def test_codes_of_items_and_documents_agree():
    a, b = (word_codes(pa.array([t]), SIGNS)[0] for t in ("Two, words", "two words"))
    assert (a == b).all()
