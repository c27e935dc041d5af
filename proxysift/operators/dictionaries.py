"""Dense, ordered ids for distinct strings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proxysift.session import durable

# monotonically_increasing_id puts the partition above this bit and the row below it.
_ROW_BITS = 33


def dense_index(keys: DataFrame, key: str, index: str, index_type: str = "bigint") -> DataFrame:
    """``key, index``: distinct keys numbered from 0 in ascending order.

    The keys are range-partitioned and sorted, each row's partition and place in it are
    stored, and the sizes of the partitions before it are added. Only the partition sizes,
    one row per partition, meet in a single task.
    """
    placed = durable(
        keys.select(key).distinct().orderBy(key)
        .withColumn("_place", F.monotonically_increasing_id())
        .select(
            key,
            F.shiftright("_place", _ROW_BITS).alias("_part"),
            F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
        )
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    return placed.join(F.broadcast(starts), "_part").select(
        key, (F.col("_start") + F.col("_row")).cast(index_type).alias(index)
    )


def word_dictionary(counts: DataFrame) -> DataFrame:
    """``word, word_number`` of a document-word count table."""
    return dense_index(counts, "word", "word_number", "int")


def document_dictionary(counts: DataFrame) -> DataFrame:
    """``document_name, document_number`` of a document-word count table."""
    names = counts.select(F.col("clientip").alias("document_name"))
    return dense_index(names, "document_name", "document_number")
