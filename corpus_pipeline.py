"""A pipeline over ``documents``: five stages, each written as Parquet and read by the next.

A document is told by (doc_id, hash of its text) where a stage's decisions meet its rows
again, so rows that repeat both are one document: they are kept or dropped together, and the
near-copy stage keeps one of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proxysift.llm import decontamination, mixing, ngram_join, span_dedup, toxicity
from proxysift.llm.common import table
from proxysift.session import durable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Near copies: five words and a similarity of 0.8.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _decided(docs: DataFrame, decisions: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose document is (``left_semi``) or is not (``left_anti``) among the
    decisions (``doc_id, mark``). Columns travel as one, so that no name can clash."""
    chosen = decisions.select("doc_id", "mark").distinct()
    held = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("held"),
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"),
    )
    same: Column = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("mark"))
    return held.join(chosen, same, how).select("held.*")


def _unused(name: str, docs: DataFrame) -> str:
    """``name``, made longer until no column of ``docs`` is called so."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    tagger = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scores = toxicity.toxicity_scores(docs.select("doc_id", "text"), tagger)
    return _decided(docs, scores.where("predicted = 1"), "left_anti")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.

    Documents without words are linked to nothing and stay.
    """
    groups = ngram_join.similar_components(docs.select("doc_id", "text"), NEAR_WORDS, NEAR_PERCENT)
    chosen = groups.where((F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = _decided(docs, chosen, "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the sentences of passages that stand in an earlier place."""
    removed, total = _unused("_removed", docs), _unused("_sentences", docs)
    stripped = span_dedup.without_repeated_spans(docs, removed=removed, total=total)
    size = F.when(F.col(removed) > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return stripped.withColumn("n_chars", size).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    matches = decontamination.benchmark_matches(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return _decided(docs, matches.where(F.size("spans") > 0), "left_anti")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, a row per copy."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("benchmark_decontamination", without_benchmark),
    ("source_mix", mixed_sources),
]

# A trained model decides in the first stage. Tests compare the operators with brute-force versions,
# and two of the stages with what their operators decide; the chain as a whole is not compared.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
