"""Topic-anomaly analysis from cleaned records to the ranked suspicious ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import LDAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proxysift.operators import (
    DrawnTopics,
    agent_counts,
    batch_fraction,
    document_word_counts,
    filter_suspicious,
    fit_drawn,
    fit_topics,
    least_likely_first,
    lookup_join,
    mix_by_joins,
    normalise_weights,
    score_pairs,
    topic_mix,
    topic_weights,
    vector_corpus,
    with_words,
    word_dictionary,
)
from proxysift.params import AnalysisParams
from proxysift.session import durable, released
from proxysift.sources import save_model, write_table


@dataclass(frozen=True)
class Trained:
    """A fitted model and the tables that scoring needs."""

    model: LDAModel | DrawnTopics
    worded: DataFrame
    counts: DataFrame
    mix: DataFrame
    probs: DataFrame


def train(records: DataFrame, ranked: DataFrame, params: AnalysisParams) -> Trained:
    """Words, corpus and topic model of cleaned records.

    The records are read twice, for the agent counts and for the words, which are made once and
    stored beside the records' columns. ``optimizer`` is ``online`` or ``em`` (Spark's own fits)
    or ``drawn`` (``operators.fit_drawn``); with the last one ``model_path`` gets a table of weights.
    """
    agents, ranked = durable(agent_counts(records)), durable(ranked)
    worded = durable(with_words(records, ranked, agents, params.own_domain))
    counts = durable(document_word_counts(worded))
    words = word_dictionary(counts)
    if params.optimizer == "drawn":
        return _train_drawn(worded, counts, words, params)
    corpus = durable(vector_corpus(counts, words, words.count()))
    corpus.persist(StorageLevel.MEMORY_AND_DISK)
    model = fit_topics(corpus, corpus.count(), params)
    if params.model_path:
        save_model(model, params.model_path)
    mix = durable(topic_mix(model, corpus))
    probs = durable(normalise_weights(topic_weights(model, words)))
    corpus.unpersist()
    return Trained(model, worded, counts, mix, probs)


def _train_drawn(worded: DataFrame, counts: DataFrame, words: DataFrame, params: AnalysisParams) -> Trained:
    """The model whose iterations read drawn documents only; no table passes through the driver."""
    words = durable(words)
    entries = durable(lookup_join(counts, words, "word", "inner").select("clientip", "word_number", "word_count"))
    documents = entries.select("clientip").distinct().count()
    model = fit_drawn(entries, words, documents, params, params.batch or batch_fraction(documents))
    if params.model_path:
        write_table(model.weights, params.model_path, mode="overwrite")
    mix = durable(mix_by_joins(entries, model.weights, model.alpha))
    long = model.weights.select(F.col("word_number").cast("int").alias("word_number"), F.posexplode("weights").alias("topic", "weight"))
    named = lookup_join(long, words, "word_number", "inner").select("word", "topic", "weight")
    return Trained(model, worded, counts, mix, durable(normalise_weights(named)))


def detect_anomalies(records: DataFrame, ranked: DataFrame, params: AnalysisParams) -> DataFrame:
    """Suspicious records with their ``word`` and ``score``, least likely first.

    The distinct (client, word) pairs are scored and filtered, and the records meet only the
    suspicious pairs: a key of client and word spreads a busy client over many partitions,
    and a record carries no topic array through a shuffle.
    """
    trained = train(records, ranked, params)
    worded = trained.worded
    pairs = score_pairs(trained.counts, trained.mix, trained.probs, params.topics)
    unlikely = durable(filter_suspicious(pairs, params.threshold))
    suspicious = lookup_join(worded, unlikely, ["clientip", "word"], "inner").select(*worded.columns, "score")
    if params.top is None:
        # A full sort samples its input before it reads it; the words are not made twice.
        suspicious = durable(suspicious)
    return least_likely_first(suspicious, params.top)


def run_analysis(spark: SparkSession, records: DataFrame, ranked: DataFrame, params: AnalysisParams, out_path: str) -> None:
    """Write the suspicious records, least likely first, and remove the derived tables.

    Without ``top`` the files are in order of the score, each file by itself.
    """
    with released(spark):
        write_table(detect_anomalies(records, ranked, params), out_path, mode="overwrite")
