"""Mix sources to target weights by systematic sampling.

Every source has a target number of words. All its documents expect ``target / source_size``
copies. Laid end to end in order of size, the expected copies form a line; one offset per
source is added, and a document is emitted once per integer boundary that its piece of the
line crosses. Because the line is ordered by size, every stretch of it is sampled alike and
the words taken differ from the target by about one document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proxysift.llm.common import row_hash, word_count
from proxysift.session import durable

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0
SEED = "mix"

# monotonically_increasing_id puts the partition above this bit and the row below it.
_ROW_BITS = 33


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES
) -> DataFrame:
    """``source, source_size, target`` of a table ``source, size``.

    Sources by code point, null last, take the weights in turn. Together they get ``share``
    times all words by weight, none more than ``most`` times its own; the excess is shared
    again among the others. The end of that is one level per unit of weight: sources sorted
    by cap per weight are full up to some place, and the level is the largest value of
    (what the ones before leave) / (weight of the rest). One row per source is windowed.
    """
    if share > most:
        raise ValueError("a share above the cap cannot be placed")
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(ordered) - 1) % len(weights) + 1)
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_weight", weight)
    cap = F.col("source_size") * most
    by_cap = Window.orderBy(cap / F.col("_weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("source_size").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    left = F.sum("source_size").over(everything) * share - before * most
    leveled = totals.withColumn("_level", left / rest)
    level = F.max("_level").over(everything)
    return leveled.select("source", "source_size", F.least(cap, level * F.col("_weight")).alias("target"))


def offset(source: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the source alone, so reruns agree."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(source, F.lit("\0"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sampled(sizes: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, mark, source_size, target, copies`` of ``doc_id, source, size, mark``.

    The place of a document within its source comes from a range sort of narrow rows: its
    place in its partition plus the sizes of the partitions before it. Only counts per
    (partition, source) meet in a window, so a source with most of the rows is spread.
    """
    placed = durable(
        sizes.orderBy(F.col("source").asc_nulls_last(), "size", F.col("doc_id").asc_nulls_last(), "mark")
        .withColumn("_place", F.monotonically_increasing_id())
        .select("*", F.shiftright("_place", _ROW_BITS).alias("_part"))
    )
    before = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("source", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
        .select(F.col("source").alias("_source"), F.col("_part").alias("_p"), "_start")
        .join(targets.withColumnRenamed("source", "_s"), F.col("_source").eqNullSafe(F.col("_s")))
        .drop("_s")
    )
    joined = placed.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_p")))
    rank = (F.col("_start") + F.col("_place")).cast("double")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shift = offset(F.col("source"), seed)
    copies = F.floor((rank + 1) * rate + shift) - F.floor(rank * rate + shift)
    return joined.select("doc_id", "source", "size", "mark", "source_size", "target", copies.alias("copies"))


def _sizes(docs: DataFrame) -> DataFrame:
    size = word_count(F.col("text"))
    return docs.select("doc_id", "source", size.alias("size"), row_hash(F.col("text")).alias("mark"))


def mix_plan(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    most: float = MOST_COPIES, seed: str = SEED,
) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes.

    A null or empty text has size 0 and takes nothing; a source without words has target 0;
    repeated rows count as documents of their own; an empty table gives an empty plan.
    """
    sizes = _sizes(docs)
    plan = sampled(sizes, source_targets(sizes, weights, share, most), seed)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    most: float = MOST_COPIES, seed: str = SEED, copy: str = "copy",
) -> DataFrame:
    """The documents of the mix with all their columns, once per copy, numbered in ``copy``.

    Rows that repeat doc_id, source and text are drawn each for itself, and their copies are
    emitted from one of them.
    """
    sizes = _sizes(docs)
    plan = sampled(sizes, source_targets(sizes, weights, share, most), seed)
    drawn = plan.groupBy("doc_id", "source", "mark").agg(F.sum("copies").alias("copies")).where("copies > 0")
    # The other columns travel as one, so that none of their names can clash.
    kept = [name for name in docs.columns if name != copy]
    marked = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in kept]).alias("held"), row_hash(F.col("text")).alias("mark"),
        F.col("doc_id").alias("id"), F.col("source").alias("from"),
    ).dropDuplicates(["id", "from", "mark"])
    same = (
        F.col("doc_id").eqNullSafe(F.col("id")) & (marked["mark"] == drawn["mark"])
        & F.col("source").eqNullSafe(F.col("from"))
    )
    numbers = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(copy)
    return marked.join(drawn, same).select(*[F.col("held").getField(name).alias(name) for name in kept], numbers)
