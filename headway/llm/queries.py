"""The registered queries of the subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm import warc
from headway.llm.alignment import align
from headway.llm.backoff import backoff_scores
from headway.llm.cotraining import score_quality
from headway.llm.decontaminate import benchmark_hits
from headway.llm.lines import line_repeats
from headway.llm.minhash import near_duplicates
from headway.llm.negatives import hard_negatives
from headway.llm.order_minhash import order_fingerprints
from headway.llm.packing import pack
from headway.llm.passages import near_passages
from headway.llm.rules import apply_rules
from headway.llm.shared import set_batches, shared_folder
from headway.llm.toxicity import score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return set_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "archive")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    warc.write_archive(_table(spark, sf_dir, "pages"), folder, buckets=buckets)
    return warc.record_table(warc.read_records(spark, folder, buckets))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_passages(_table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """The documents packed with the public byte-level tokenizer."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("spans")


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    repeats = line_repeats(_table(spark, sf_dir, "documents"))
    return repeats.withColumn("removed_lines", F.array_join("removed_lines", ","))


def op9_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = backoff_scores(_table(spark, sf_dir, "documents"))
    return scores.select("doc_id", "n_words", F.round("log_score", 5).alias("log_score"), F.round("mean_log_score", 7).alias("mean_log_score"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_fingerprints(_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings").withColumn("label", label))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_cotraining": op2_cotraining,
    "op3_warc": op3_warc,
    "op4_minhash": op4_minhash,
    "op5_passages": op5_passages,
    "op6_packing": op6_packing,
    "op7_decontaminate": op7_decontaminate,
    "op8_lines": op8_lines,
    "op9_backoff": op9_backoff,
    "op10_order_minhash": op10_order_minhash,
    "op11_alignment": op11_alignment,
    "op12_quality_rules": op12_quality_rules,
    "op13_hard_negatives": op13_hard_negatives,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op3_warc": """
        with p as (
            select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n,
                   min(page_id) over (partition by coalesce(html, '')) as first
            from pages
        )
        select page_id, n as payload_bytes, sha256(body) as payload_digest,
               case when n >= 100 and page_id != first then 'revisit' else 'response' end as record_type,
               case when n >= 100 and page_id != first then first end as refers_to
        from p
    """,
    "op7_decontaminate": rf"""
        with d as (
            select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
        ),
        b as (
            select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
        ),
        bw as (
            select item_id, w, least(len(w), 10) as m, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
            from b where len(w) > 0
        ),
        win as (select distinct item_id, m, array_to_string(w[i : i + m - 1], ' ') as s from bw),
        lens as (select distinct m from win),
        dw as (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from d join lens on len(w) >= m),
        hit as (
            select doc_id, item_id, i, win.m from dw join win
            on win.m = dw.m and win.s = array_to_string(w[i : i + dw.m - 1], ' ')
        ),
        words as (
            select doc_id, count(*) as n_hit from (
                select distinct doc_id, unnest(range(i, i + m)) as at from hit
            ) group by doc_id
        ),
        items as (
            select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
            from (select distinct doc_id, cast(item_id as varchar) as id from hit) group by doc_id
        )
        select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
               coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from d left join words on d.doc_id = words.doc_id left join items on d.doc_id = items.doc_id
    """,
    "op8_lines": rf"""
        with l as (
            select doc_id, generate_subscripts(string_split(lower(coalesce(text, '')), chr(10)), 1) - 1 as line,
                   unnest(string_split(lower(coalesce(text, '')), chr(10))) as s
            from documents
        ),
        w as (
            select doc_id, line, regexp_extract_all(s, '[^\x20\x09-\x0D]+') as w from l
        ),
        g as (
            select distinct doc_id, line, array_to_string(w[i : i + 4], ' ') as g
            from (select doc_id, line, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0)
        ),
        n as (select doc_id, line, count(*) as n from g group by all),
        pairs as (
            select x.doc_id, x.line, y.doc_id as y_doc, y.line as y_line, count(*) as common
            from g x join g y on x.g = y.g and (y.doc_id, y.line) < (x.doc_id, x.line) group by all
        ),
        gone as (
            select distinct p.doc_id, p.line from pairs p
            join n as a on a.doc_id = p.doc_id and a.line = p.line
            join n as b on b.doc_id = p.y_doc and b.line = p.y_line
            where 100 * common >= 75 * (a.n + b.n - common)
        ),
        by_doc as (
            select doc_id, count(*) as n_removed, string_agg(line, ',' order by line) as removed_lines from gone group by doc_id
        )
        select d.doc_id, cast(len(string_split(coalesce(d.text, ''), chr(10))) as bigint) as n_lines,
               coalesce(n_removed, 0) as n_removed, coalesce(removed_lines, '') as removed_lines
        from documents d left join by_doc on by_doc.doc_id = d.doc_id
    """,
    "op9_backoff": rf"""
        with d as (
            select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents
        ),
        p as (select doc_id, len(w) as n, w, unnest(range(1, len(w) + 1)) as i from d),
        u as (select doc_id, n, i, w[i] as b, case when i > 1 then w[i - 1] end as a from p),
        one as (select b, count(*) as c from u group by b),
        own_one as (select doc_id, b, count(*) as c from u group by doc_id, b),
        two as (select a, b, count(*) as c from u where a is not null group by a, b),
        own_two as (select doc_id, a, b, count(*) as c from u where a is not null group by doc_id, a, b),
        s as (
            select u.doc_id,
                   case when u.a is not null and two.c > own_two.c
                        then ln((two.c - own_two.c) / greatest(first.c - own_first.c, 1))
                        else ln(greatest(one.c - own_one.c, 1) / greatest((select sum(len(w)) from d) - u.n, 1))
                             + case when u.a is null then 0 else ln(0.4) end
                   end as v
            from u join one on one.b = u.b
            join own_one on own_one.doc_id = u.doc_id and own_one.b = u.b
            left join two on two.a = u.a and two.b = u.b
            left join own_two on own_two.doc_id = u.doc_id and own_two.a = u.a and own_two.b = u.b
            left join one as first on first.b = u.a
            left join own_one as own_first on own_first.doc_id = u.doc_id and own_first.b = u.a
        ),
        t as (select doc_id, sum(v) as total from s group by doc_id)
        select d.doc_id, cast(len(w) as bigint) as n_words, round(coalesce(total, 0.0), 5) as log_score,
               round(total / nullif(len(w), 0), 7) as mean_log_score
        from d left join t on d.doc_id = t.doc_id
    """,
    "op13_hard_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        s as (
            select a.vec_id as anchor, b.vec_id as id, a.label = b.label as same,
                   cast(list_dot_product(a.q, b.q) as bigint) as score
            from v as a join v as b on a.vec_id % 50 = 0
        ),
        p as (
            select anchor, id, score from s where same and id != anchor
            qualify row_number() over (partition by anchor order by score desc, id) <= 5
        ),
        n as (
            select p.anchor, p.id as positive_id, p.score as positive_score, s.id, s.score,
                   row_number() over (partition by p.anchor, p.id order by s.score desc, s.id) as rank
            from p join s on s.anchor = p.anchor and not s.same and 100 * s.score between 50 * p.score and 95 * p.score
        )
        select anchor as anchor_id, positive_id, cast(rank as int) as rank, id as negative_id, positive_score, score as negative_score
        from n where rank <= 3
    """,
}
