"""Topic model: fit, topic mix per document, word probabilities per topic."""

from __future__ import annotations

from pyspark.ml.clustering import LDA, LDAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proxysift.functions import widen
from proxysift.operators.lookup import lookup_join
from proxysift.params import AnalysisParams


def batch_fraction(documents: int) -> float:
    """Share of the corpus drawn per online iteration, about one document."""
    return 0.75 if documents < 2 else (0.05 + 1) / documents


def fit_topics(corpus: DataFrame, documents: int, params: AnalysisParams) -> LDAModel:
    """Fit a topic model on ``features``; pass a persisted corpus, it is read every iteration.

    The EM optimizer accepts only priors above 1 and chooses its own otherwise.
    """
    lda = LDA(
        featuresCol="features", k=params.topics, maxIter=params.iterations,
        optimizer=params.optimizer, seed=params.seed,
    )
    if params.optimizer == "online":
        lda = lda.setOptimizeDocConcentration(True).setSubsamplingRate(params.batch or batch_fraction(documents))
    least = 1.0 if params.optimizer == "em" else 0.0
    if params.alpha is not None and params.alpha > least:
        lda = lda.setDocConcentration([params.alpha])
    if params.beta is not None and params.beta > least:
        lda = lda.setTopicConcentration(params.beta)
    return lda.fit(corpus)


def topic_mix(model: LDAModel, corpus: DataFrame, key: str = "clientip") -> DataFrame:
    """``document_name, topic_prob_mix``; the key travels through the model's transform."""
    mixed = model.transform(corpus)
    return mixed.select(
        F.col(key).alias("document_name"),
        vector_to_array("topicDistribution").alias("topic_prob_mix"),
    )


def mix_by_document_name(mix: DataFrame, documents: DataFrame) -> DataFrame:
    """Replace ``document_number`` of a mix table by the name from the dictionary."""
    named = lookup_join(mix, documents, "document_number", "inner")
    return named.select("document_name", widen(F.col("topic_prob_mix")).alias("topic_prob_mix"))


def topic_weights(model: LDAModel, words: DataFrame) -> DataFrame:
    """``word, topic, weight`` for every word and topic of the model."""
    topics = model.describeTopics(model.vocabSize())
    long = topics.select(
        "topic", F.inline(F.arrays_zip(F.col("termIndices").alias("word_number"),
                                       F.col("termWeights").alias("weight")))
    )
    return lookup_join(long, words, "word_number", "inner").select("word", "topic", "weight")


def saved_topic_weights(spark: SparkSession, path: str, words: DataFrame) -> DataFrame:
    """``word, topic, weight`` of a distributed model that was saved at ``path``.

    The saved graph has a vertex per word, with a negative number, that holds the word's
    weights; they are read as a table, so no topic passes through the driver.
    """
    vertices = spark.read.parquet(f"{path}/oldModel/data/topicCounts").where("id < 0")
    long = vertices.select(
        (-F.col("id") - 1).cast("int").alias("word_number"),
        F.posexplode(vector_to_array("topicWeights")).alias("topic", "weight"),
    )
    sums = long.groupBy("topic").agg(F.sum("weight").alias("_total"))
    shares = long.join(F.broadcast(sums), "topic").select(
        "word_number", "topic", (F.col("weight") / F.col("_total")).alias("weight")
    )
    return lookup_join(shares, words, "word_number", "inner").select("word", "topic", "weight")


def normalise_weights(weights: DataFrame) -> DataFrame:
    """``word, topic_probs``: each topic's weights divided by their sum, ordered by topic.

    The sums are one row per topic, so they are joined by broadcast; no topic's column has
    to pass through one task. A word without a weight for each topic, once, is an error.
    """
    sums = weights.groupBy("topic").agg(F.sum("weight").alias("total"))
    shares = weights.join(F.broadcast(sums), "topic").select(
        "word", F.struct(F.col("topic").cast("int").alias("topic"), (F.col("weight") / F.col("total")).alias("p")).alias("entry")
    )
    topics = [row.topic for row in sums.select("topic").orderBy("topic").collect()]
    whole = F.col("entries.topic") == F.array(*map(F.lit, topics)).cast("array<int>")
    lacking = F.raise_error(F.concat(F.lit("no weight for each topic: "), "word")).cast("array<double>")
    return shares.groupBy("word").agg(F.sort_array(F.collect_list("entry")).alias("entries")).select(
        "word", F.when(whole, F.col("entries.p")).otherwise(lacking).alias("topic_probs")
    )


def with_dominant_topic(mix: DataFrame) -> DataFrame:
    """Append ``maxV``, the largest topic share of a document."""
    return mix.withColumn("maxV", F.array_max("topic_prob_mix"))
