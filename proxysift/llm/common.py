"""Column helpers that several of the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proxysift.session import durable

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    is_ascii = F.octet_length(text) == F.char_length(text)
    return F.when(is_ascii, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def row_hash(*columns: Column) -> Column:
    """One 64-bit value per content, so that rows of equal content are one document."""
    return F.xxhash64(*columns)


# A key is hot with more rows than this, and than one of HOT_PARTS parts of all rows.
HOT_ROWS = 1_000
HOT_PARTS = 10_000


def join_spread(rows: DataFrame, facts: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` with the one row of ``facts`` per key; ``n`` in it, dropped, counts the rows of the key.

    Rows of hot keys stay where they are and the facts of those keys, fewer than ``HOT_PARTS``,
    are broadcast; all others are joined by shuffle. ``how`` is ``inner`` or ``left``. Both
    tables are read more than once and should be stored.
    """
    total = facts.agg(F.sum("n")).first()[0] or 0
    hot = durable(facts.where(F.col("n") > max(HOT_ROWS, total // HOT_PARTS)).drop("n"))
    facts = facts.drop("n")
    if hot.isEmpty():
        return rows.join(facts, key, how)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(facts, key, how)
    return rest.unionByName(rows.join(F.broadcast(hot), key))
