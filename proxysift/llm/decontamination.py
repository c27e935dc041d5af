"""Find benchmark passages in documents by winnowing.

A text's fingerprint is the set of the smallest k-gram hashes of every ``w`` consecutive
k-grams. Two texts that share ``w + k - 1`` words share a fingerprint, so with
``w + k - 1`` equal to the window every shared window meets in the join. A hit carries the
hashes of the words around it and is extended to both sides; if the run reaches the window,
its words are hit. All of it is DataFrame expressions.

Words are compared by their 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proxysift.llm.common import ascii_lower
from proxysift.operators.lookup import fits_broadcast
from proxysift.session import durable

WINDOW = 10
GRAM = 5

# Letters, digits and everything that is not ASCII.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


_PRINTS = "array<struct<span:int,place:int,print:bigint,around:array<bigint>,skip:int>>"


def text_words(text: Column) -> Column:
    """Words in lower case (A-Z); none for null."""
    return F.coalesce(
        F.regexp_extract_all(ascii_lower(text), F.lit(ITEM_WORD), F.lit(0)), F.array().cast("array<string>")
    )


def _scheme(window: int) -> tuple[int, int]:
    """Words of a gram and grams of a winnowing window that cover a window of words."""
    gram = min(GRAM, window)
    return gram, window - gram + 1


def _prints(words: Column, window: int) -> Column:
    """The selected grams of an array of word hashes, at each place where one is selected.

    Each has its ``span`` (the window), ``place``, ``print`` (its hash), the words ``around``
    it as far as a window with it can reach, and ``skip``, its place among those.
    """
    gram, width = _scheme(window)
    reach = width - 1
    n_grams = F.size(words) - (gram - 1)
    grams = F.transform(
        F.sequence(F.lit(0), n_grams - 1),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(gram)]),
    )

    def smallest_of(values: Column) -> Column:
        if width == 1:
            return values
        return F.transform(
            F.sequence(F.lit(0), F.greatest(n_grams - width, F.lit(0))),
            lambda i: F.least(*[F.get(values, i + j) for j in range(width)]),
        )

    def selected(bound: Column) -> Column:
        smallest = bound["smallest"]

        def entry(value: Column, i: Column) -> Column:
            last = F.size(smallest) - 1
            # A gram is selected if it is the smallest of one of the windows around it.
            chosen = F.lit(False)
            for j in range(width):
                chosen = chosen | F.coalesce(F.get(smallest, F.least(i - j, last)) == value, F.lit(False))
            first = F.greatest(i - reach, F.lit(0))
            around = F.slice(words, first + 1, F.lit(gram + 2 * reach))
            return F.when(chosen, F.struct(
                F.lit(window).alias("span"), i.alias("place"), value.alias("print"),
                around.alias("around"), (i - first).alias("skip"),
            ))

        return F.filter(F.transform(bound["grams"], entry), lambda x: x.isNotNull())

    # One-element arrays bind what is used many times to a name.
    bound = F.transform(
        F.transform(F.array(grams), lambda g: F.struct(g.alias("grams"), smallest_of(g).alias("smallest"))), selected
    )
    return F.when(n_grams < 1, F.array().cast(_PRINTS)).otherwise(F.get(bound, F.lit(0)))


def _run(step: int, start: Column, item_start: Column, reach: int) -> Column:
    """Number of equal words from ``start`` on, going left or right, up to ``reach``."""
    length = F.lit(0)
    for j in reversed(range(reach)):
        same = F.get("around", start + step * j) == F.get("item_around", item_start + step * j)
        length = F.when(F.coalesce(same, F.lit(False)), length + 1).otherwise(0)
    return length


def _extended(window: int) -> Column:
    """Start and stop of the run of equal words around a hit; null if it is no window."""
    gram, width = _scheme(window)
    left = _run(-1, F.col("skip") - 1, F.col("item_skip") - 1, width - 1)
    right = _run(1, F.col("skip") + gram, F.col("item_skip") + gram, width - 1)
    same = _run(1, F.col("skip"), F.col("item_skip"), gram)
    run = F.struct((F.col("place") - left).alias("start"), (F.col("place") + gram + right).alias("stop"))
    return F.when((same == gram) & (left + right + gram >= window), run)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, mark, n_words, spans, items`` per row of ``docs``: hit spans and items found.

    ``docs`` has ``doc_id, text``, ``benchmark`` has ``item_id, text``. An item shorter than
    the window is one window of its own; its fingerprints are cut to its length. Null and
    empty texts have no words, hit nothing and are found nowhere; repeated rows each get
    their row; ``mark`` is a hash of the text. The fingerprints of the benchmark are
    broadcast if their measured size allows and are joined by shuffle otherwise.
    """
    hashes = F.transform(text_words(F.col("text")), lambda w: F.xxhash64(w))
    items = durable(
        benchmark.select("item_id", hashes.alias("words"))
        .withColumn("length", F.least(F.size("words"), F.lit(window))).where("length > 0")
    )
    # At most ``window`` different lengths come to the driver.
    lengths = sorted(row.length for row in items.select("length").distinct().collect())
    none = F.array().cast(_PRINTS)
    of_length = none
    for length in lengths:
        of_length = F.when(F.col("length") == length, _prints(F.col("words"), length)).otherwise(of_length)
    index = durable(
        items.select("item_id", F.explode(of_length).alias("p"))
        .select("item_id", F.col("p.span").alias("span"), F.col("p.print").alias("print"),
                F.col("p.around").alias("item_around"), F.col("p.skip").alias("item_skip")).distinct()
    )
    # Rows are numbered in the scan that everything else hangs on, so repeated rows stay apart.
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("mark"), hashes.alias("words")
    )
    # The first entry of each row is no fingerprint; it carries the row itself past the join.
    itself = F.array(F.lit(None).cast(_PRINTS.removeprefix("array<").removesuffix(">")))
    prints = rows.select(
        "row", F.size("words").cast("bigint").alias("n_words"),
        F.struct("doc_id", "mark").alias("doc"),
        F.posexplode(F.concat(itself, *[_prints(F.col("words"), n) for n in lengths])).alias("at", "p"),
    ).select(
        "row", F.when(F.col("at") == 0, F.col("doc")).alias("doc"), F.when(F.col("at") == 0, F.col("n_words")).alias("n_words"),
        # A span that no item has; the row's number deals these entries to all partitions.
        F.when(F.col("at") == 0, -1).otherwise(F.col("p.span")).alias("span"),
        F.when(F.col("at") == 0, F.col("row")).otherwise(F.col("p.print")).alias("print"), F.col("p.place").alias("place"),
        F.col("p.around").alias("around"), F.col("p.skip").alias("skip"),
    )
    joined = prints.join(F.broadcast(index) if fits_broadcast(index) else index, ["span", "print"], "left")
    run = F.lit(None).cast("struct<start:int,stop:int>")
    for length in lengths:
        run = F.when(F.col("span") == length, _extended(length)).otherwise(run)
    hits = joined.where("item_id IS NOT NULL OR n_words IS NOT NULL").withColumn("run", run)
    hits = hits.where("run IS NOT NULL OR n_words IS NOT NULL")
    # Equal spans and items are merged before they meet: a document has no more spans than places.
    found = hits.select(
        "row", "doc", "n_words", "run", F.when(F.col("run").isNotNull(), F.col("item_id").cast("string")).alias("item")
    )
    return found.groupBy("row").agg(
        F.first("doc", ignorenulls=True).alias("doc"), F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set("run")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"),
    ).select("doc.doc_id", "doc.mark", "n_words", "spans", "items")


def covered(spans: Column) -> Column:
    """Number of places in the union of sorted spans."""
    start = F.struct(F.lit(0).alias("until"), F.lit(0).cast("bigint").alias("total"))

    def add(state: Column, span: Column) -> Column:
        new = F.greatest(span["stop"] - F.greatest(span["start"], state["until"]), F.lit(0))
        return F.struct(F.greatest(state["until"], span["stop"]).alias("until"), (state["total"] + new).alias("total"))

    return F.aggregate(spans, start, add, lambda state: state["total"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document the number of words, of words inside benchmark windows, and the items."""
    matches = benchmark_matches(docs, benchmark, window)
    n_hit = covered(F.col("spans"))
    return matches.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
