"""A training corpus from raw documents: each stage's result is written, and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.cotraining import keep_quality
from headway.llm.decontaminate import benchmark_hits
from headway.llm.lines import drop_repeated_lines, keyed
from headway.llm.minhash import near_duplicates
from headway.llm.queries import packed
from headway.llm.shared import set_batches, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the co-trained classifier accepts."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat an earlier one, n_chars as it is then; no document goes."""
    cut = drop_repeated_lines(docs)
    return cut.select(*[F.char_length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(c) for c in cut.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the smallest id, after rows without an id of their own.

    Documents whose text is empty or blank link with nothing and stay.
    """
    rows = keyed(docs)
    gone = near_duplicates(rows, "key").where("not kept").select(F.col("doc_id").alias("key")).distinct()
    kept = rows.join(gone.hint("merge"), "key", "left_anti")
    again = written(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeated_rows")
    if not again.isEmpty():  # rows of the same id and text
        many = kept.join(again.hint("merge"), "key", "left_semi")
        blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
        kept = kept.join(again.hint("merge"), "key", "left_anti").unionAll(many.where(blank)).unionAll(many.where(~blank).dropDuplicates(["key"]))
    return kept.select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window; rows without an id of their own are judged by themselves."""
    rows = keyed(docs)
    hits = benchmark_hits(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "key")
    gone = hits.where("contaminated").select(F.col("doc_id").alias("key")).distinct()
    return rows.join(gone.hint("merge"), "key", "left_anti").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The first stage is learned and the last one greedy, which SQL cannot express; tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = set_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(set_batches(spark), docs, sf_dir), name)
    return docs
