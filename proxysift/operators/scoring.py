"""Likelihood of each record's word for its client; low scores are the anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proxysift import constants as C
from proxysift.functions import dot, widen
from proxysift.functions.binding import with_bound
from proxysift.operators.lookup import lookup_join

TIE_BREAKERS = ("clientip", "p_date", "p_time", "word")


def word_score(mix: Column, word: Column, probs: Column, topics: int) -> Column:
    """Sum over topics of P(topic | client) * P(word | topic).

    A record without a word scores -1; an unseen client or word has no probability, so 0.
    Arrays that do not have a value for each topic are an error.
    """
    whole = (F.size(mix) == topics) & (F.size(probs) == topics)
    wrong = F.raise_error(F.lit(f"an array of probabilities has not {topics} values")).cast("double")
    product = F.when(mix.isNull() | probs.isNull(), 0.0).when(whole, dot(mix, probs, topics)).otherwise(wrong)
    return F.when(word == C.WORD_ERROR, C.SCORE_ERROR).otherwise(product)


def score_records(df: DataFrame, mix: DataFrame, probs: DataFrame, topics: int) -> DataFrame:
    """Append ``score`` to any table with ``clientip`` and ``word``."""
    by_client = mix.select(F.col("document_name").alias("clientip"), widen(F.col("topic_prob_mix")).alias("_mix"))
    by_word = probs.select("word", F.col("topic_probs").alias("_probs"))
    joined = lookup_join(lookup_join(df, by_word, "word"), by_client, "clientip")
    score = word_score(F.col("_mix"), F.col("word"), F.col("_probs"), topics)
    return with_bound(joined, "score", score).select(*df.columns, "score")


def score_pairs(counts: DataFrame, mix: DataFrame, probs: DataFrame, topics: int) -> DataFrame:
    """``clientip, word, score`` of the counted pairs.

    Every record of a pair has the same score, so scoring the pairs and joining the records
    with the result moves far less data than carrying topic mixes to each record.
    """
    return score_records(counts.select("clientip", "word"), mix, probs, topics)


def filter_suspicious(scored: DataFrame, threshold: float = C.SCORE_THRESHOLD) -> DataFrame:
    """Scores up to and including the threshold, without records that have no word."""
    return scored.where((F.col("score") <= threshold) & (F.col("score") > C.SCORE_ERROR))


def out_of_order(written: DataFrame, key: str = "score") -> DataFrame:
    """``files, within, between``: neighbours of a written, range-sorted table that are out of order.

    Rows are compared with the row before them in their file, by their place in it, and the
    largest key of a file with the least one of the next file that has rows. The files of a
    sorted write are in order of their names.
    """
    rows = written.select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"), F.col(key).alias("key")
    )
    by_place = Window.partitionBy("file").orderBy("place")
    stepped = rows.select("file", "key", F.lag("key").over(by_place).alias("before"))
    manifest = stepped.groupBy("file").agg(
        F.min("key").alias("least"), F.max("key").alias("largest"), F.count_if(F.col("key") < F.col("before")).alias("within")
    )
    # One row per file.
    joined = manifest.select("within", "least", F.lag("largest").over(Window.orderBy("file")).alias("before"))
    return joined.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("within"), F.lit(0)).alias("within"),
        F.count_if(F.col("least") < F.col("before")).alias("between"),
    )


def least_likely_first(scored: DataFrame, top: int | None = None) -> DataFrame:
    """Ascending by score; ``top`` keeps the first ones.

    Ties are broken by client, time, word, then the other columns. Copies of one record,
    which may be a large share of all, are spread by the partition they come from, so that
    the range sort can divide them; that number is the same when a task is run again.
    """
    ties = [name for name in TIE_BREAKERS if name in scored.columns]
    others = [name for name in scored.columns if name not in ("score", *ties)]
    placed = scored.withColumn("_source", F.spark_partition_id())
    ordered = placed.orderBy("score", *ties, *others, "_source").drop("_source")
    return ordered if top is None else ordered.limit(top)
