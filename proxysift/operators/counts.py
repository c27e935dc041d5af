"""Group counts; both combine inside the scan tasks before any row is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxysift import constants as C


def agent_counts(df: DataFrame) -> DataFrame:
    """``useragent, count`` over all records."""
    return df.groupBy("useragent").count()


def with_valid_word(worded: DataFrame) -> DataFrame:
    """Only records that have a word."""
    return worded.where(F.col("word") != C.WORD_ERROR)


def document_word_counts(worded: DataFrame) -> DataFrame:
    """``clientip, word, word_count`` without records that have no word."""
    return (
        with_valid_word(worded)
        .groupBy("clientip", "word")
        .agg(F.count(F.lit(1)).alias("word_count"))
    )
