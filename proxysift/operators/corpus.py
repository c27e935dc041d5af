"""The training corpus, as a long table and as one sparse vector per document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxysift.functions import sparse_vector
from proxysift.operators.lookup import lookup_join


def long_corpus(counts: DataFrame, words: DataFrame, documents: DataFrame) -> DataFrame:
    """``document_number, word_number, word_count``; both keys are looked up by join."""
    named = counts.withColumnRenamed("clientip", "document_name")
    numbered = lookup_join(
        lookup_join(named, words, "word", "inner"), documents, "document_name", "inner"
    )
    return numbered.select("document_number", "word_number", "word_count")


def vector_corpus(counts: DataFrame, words: DataFrame, vocabulary_size: int) -> DataFrame:
    """``clientip, features`` with one sparse vector of word counts per client.

    The input is already counted, so a client's list holds each word once and is never
    longer than the vocabulary, however many records the client has. Partitions are sorted,
    so that the documents a seeded fit draws do not depend on the order of the shuffle.
    """
    entries = lookup_join(counts, words, "word", "inner").select(
        "clientip", F.struct("word_number", "word_count").alias("entry")
    )
    grouped = entries.groupBy("clientip").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    features = sparse_vector(
        vocabulary_size, F.col("entries.word_number"), F.col("entries.word_count")
    )
    return grouped.select("clientip", features.alias("features")).sortWithinPartitions("clientip")
