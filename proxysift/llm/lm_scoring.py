"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A byte is eight binary decisions. Each decision has a tree of contexts: none, the byte
before, and so on up to ``depth`` bytes before. Every node holds a Krichevsky-Trofimov
estimate; a node's weighted probability is half its own estimate and half the product of its
children, which mixes all depths by how well they code the training texts. The trained tree
gives each byte a probability in each context, and a text its code length.

A text is preceded by ``depth`` zero bytes and ended by 0xFF, which UTF-8 never holds.

The tree is a table per depth, (context, node of the byte's bits), made by Spark: counts and
weighted probabilities go up by grouping on the shorter context, the mixture comes down by
joins. A key meets at most 256 longer contexts, so there is no hot one. The tables grow with the
corpus and never pass the driver. The most frequent grams, a fixed number, are looked up where
a text is read; all others are counted per row and joined by shuffle, so the number of
looked-up grams changes the cost and no result. A gram that training never saw takes each of
its decisions from the longest context that did see it.

Beside it stands a word model with add-one smoothing. Its words are counted over the whole
training corpus; frequent ones are looked up as grams are, and all others are joined.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proxysift.llm.ngram_join import word_hashes
from proxysift.operators.lookup import lookup_join
from proxysift.session import durable

DEPTH = 4
# Contexts and the byte after them are one 64-bit number.
MOST_DEPTH = 6
END = 0xFF
HEAD_WORDS = 65_536
HEAD_GRAMS = 1 << 20
HELD_OUT = (7, 2)

_BYTES = 256
# Classes of counts, per doubling, among which frequent grams are told from rare ones.
_CLASSES = 8
_LOG_HALF = math.log(0.5)


def held_out(doc_id: Column, parts: int = HELD_OUT[0], part: int = HELD_OUT[1]) -> Column:
    """Whether a document is kept from training; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def _framed(texts: list[str], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, framed, and where each begins."""
    frames = [b"\0" * depth + text.encode("utf-8") + bytes([END]) for text in texts]
    starts = np.cumsum([0] + [len(f) for f in frames[:-1]])
    return np.frombuffer(b"".join(frames), dtype=np.uint8), starts


def _grams(codes: np.ndarray, depth: int) -> np.ndarray:
    """For each byte from the ``depth``-th on, the context before it and itself as one number."""
    grams = np.zeros(len(codes) - depth, dtype=np.int64)
    for k in range(depth + 1):
        grams = grams * _BYTES + codes[k : len(codes) - depth + k]
    return grams


def _text_places(starts: np.ndarray, length: int, depth: int) -> np.ndarray:
    """Mask over grams: false where the byte itself is part of a frame's zeros."""
    mask = np.ones(length, dtype=bool)
    for k in range(depth):
        mask[starts[1:] + k - depth] = False
    return mask


def _slices(batch: pd.DataFrame, most: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """Pieces of a batch whose texts have about ``most`` characters together."""
    piece = batch["text"].str.len().cumsum().floordiv(most)
    for _, rows in batch.groupby(piece, sort=False):
        yield rows


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(keys, return_inverse=True)
    return found, np.bincount(where, counts, len(found)).astype(np.int64)


def corpus_counts(texts: DataFrame, depth: int = DEPTH, flush: int = 2_000_000) -> DataFrame:
    """``kind, key, n``: how often each context and byte (``gram``) and each word (``word``, by
    its hash) occur in ``text``. Tasks send what they have counted every ``flush`` entries."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {"gram": [], "word": []}

        def sent(kind: str) -> Iterator[pd.DataFrame]:
            if held[kind]:
                keys, counts = _merged(*(np.concatenate(x) for x in zip(*held[kind], strict=True)))
                held[kind] = []
                yield pd.DataFrame({"kind": kind, "key": keys, "n": counts})

        for batch in batches:
            for rows in _slices(batch):
                found = rows["text"].tolist()
                codes, starts = _framed(found, depth)
                grams = _grams(codes, depth)
                grams = grams[_text_places(starts, len(grams), depth)]
                hashes, _ = word_hashes(found)
                for kind, values in (("gram", grams), ("word", hashes.view(np.int64))):
                    keys, counts = np.unique(values, return_counts=True)
                    held[kind].append((keys.astype(np.int64), counts))
                    if sum(len(x[0]) for x in held[kind]) >= flush:
                        yield from sent(kind)
        for kind in held:
            yield from sent(kind)

    counted = texts.select("text").mapInPandas(count, "kind string, key bigint, n bigint")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: Column) -> Column:
    """Log of the gamma function for positive numbers: Stirling's series, eight steps above."""
    below = F.lit(1.0)
    for k in range(8):
        below = below * (x + float(k))
    y = x + 8.0
    square = y * y
    series = (1 / 12 - (1 / 360 - (1 / 1260 - F.lit(1 / 1680) / square) / square) / square) / y
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(below)


def _estimate(zeros: Column, ones: Column) -> Column:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    both = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5)
    return both - math.log(math.pi) - _log_gamma(zeros + ones + 1.0)


def _log_sum(a: Column, b: Column) -> Column:
    """Log of the sum of two numbers given by their logs."""
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def _shorter(context: Column, depth: int) -> Column:
    """The context's last ``depth`` bytes."""
    return context % F.lit(_BYTES**depth)


def _decisions(grams: DataFrame) -> DataFrame:
    """A row per decision of each gram's byte: ``context, node, one`` beside the given columns.

    Node 1 decides the first bit; node 2m + bit follows node m.
    """
    byte = (F.col("gram") % _BYTES).cast("int")
    steps = [
        F.struct(F.shiftright(byte + _BYTES, bit + 1).alias("node"), F.shiftright(byte, bit).bitwiseAND(F.lit(1)).alias("one"))
        for bit in range(7, -1, -1)
    ]
    context = F.shiftright(F.col("gram"), 8).alias("context")
    return grams.select("*", context, F.explode(F.array(*steps)).alias("s")).select(*grams.columns, "context", "s.node", "s.one")


def train_tree(grams: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """``context, node, base, rest`` for each depth from 0 on, from ``gram, n`` of training.

    ``base`` is what the contexts up to this one give to the probability of a one, ``rest`` the
    weight they leave to longer contexts (none at the last depth). Each table is written once
    on the way up and once on the way down.
    """
    n = F.col("n").cast("double")
    counted = _decisions(grams).groupBy("context", "node").agg(
        F.sum(F.when(F.col("one") == 0, n).otherwise(0.0)).alias("zeros"),
        F.sum(F.when(F.col("one") == 1, n).otherwise(0.0)).alias("ones"),
    )
    own = _estimate(F.col("zeros"), F.col("ones"))
    up = durable(counted.select("*", own.alias("total"), F.lit(1.0).alias("stay")))
    levels = [up]
    for level in range(depth - 1, -1, -1):
        parents = up.groupBy(_shorter(F.col("context"), level).alias("context"), "node").agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("total").alias("below")
        ).withColumn("own", own + _LOG_HALF)
        total = _log_sum(F.col("own"), F.col("below") + _LOG_HALF)
        parents = parents.select("context", "node", "zeros", "ones", "own", total.alias("total"))
        up = durable(parents.select("context", "node", "zeros", "ones", "total", F.exp(F.col("own") - F.col("total")).alias("stay")))
        levels.insert(0, up)
    one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)
    down: list[DataFrame] = []
    for level, table in enumerate(levels):
        if level:
            above = down[-1].select(F.col("context").alias("_above"), F.col("node").alias("_node"), "base", "rest")
            same = (_shorter(F.col("context"), level - 1) == F.col("_above")) & (F.col("node") == F.col("_node"))
            mixed = table.join(above, same)
        else:
            mixed = table.select("*", F.lit(0.0).alias("base"), F.lit(1.0).alias("rest"))
        base = F.col("base") + F.col("rest") * F.col("stay") * one
        down.append(durable(mixed.select(
            "context", "node", base.alias("base"), (F.col("rest") * (1.0 - F.col("stay"))).alias("rest")
        )))
    return down


def gram_logs(grams: DataFrame, tree: list[DataFrame], seen: bool = False) -> DataFrame:
    """``gram, log``: log10 of the probability of each gram's byte in its context.

    ``grams`` holds each ``gram`` once. Those ``seen`` in training have all their decisions at
    the last depth. For others a decision is taken where its longest known context is; what lies
    below that, or a decision that was never seen, says one half.
    """
    rows = _decisions(grams.select("gram"))
    probability = F.lit(None).cast("double")
    for level in range(len(tree) - 1, -1 if not seen else len(tree) - 2, -1):
        known = tree[level].select(
            F.col("context").alias(f"context{level}"), F.col("node").alias(f"node{level}"),
            (F.col("base") + F.col("rest") * 0.5).alias(f"p{level}"),
        )
        same = (_shorter(F.col("context"), level) == F.col(f"context{level}")) & (F.col("node") == F.col(f"node{level}"))
        # Depths 0 and 1 have at most 257 * 255 rows, and every decision falls on few of them.
        rows = rows.join(F.broadcast(known) if level < 2 else known, same, "left")
        probability = F.coalesce(probability, F.col(f"p{level}"))
    p = F.coalesce(probability, F.lit(0.5))
    log = F.log10(F.when(F.col("one") == 1, p).otherwise(1.0 - p))
    return rows.groupBy("gram").agg(F.sum(log).alias("log"))


def _frequent(logs: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams, sorted, and logs of the most frequent rows of ``gram, log, n``, at most ``most``.

    Counts are put into classes of like size, some hundreds at most; whole classes are taken
    from the top as long as they fit, so nothing is sorted and one bounded table is fetched.
    """
    size = F.floor(F.log2("n") * _CLASSES)
    taken, least = 0, None
    for row in sorted(logs.groupBy(size.alias("size")).count().collect(), reverse=True):
        taken += row["count"]
        if taken > most:
            break
        least = row["size"]
    if least is None:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    fetched = logs.where(size >= least).select("gram", "log").toArrow()
    grams, values = fetched["gram"].to_numpy(), fetched["log"].to_numpy()
    order = np.argsort(grams)
    return grams[order], values[order]


def _found(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``values`` stands in the sorted ``keys``, and whether it does."""
    if not len(keys):
        return np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return at, keys[at] == values


class _Places:
    """Places of numbers in an array of distinct ones, by open addressing: several times
    faster than a binary search where each number of a text is looked up."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.bits = max(2 * len(keys), 2).bit_length()
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.slots[slot[left]] < 0]
            self.slots[slot[free]] = free
            left = left[self.slots[slot[left]] != left]
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)

    def _slot(self, values: np.ndarray) -> np.ndarray:
        mixed = values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each value stands, and whether it does."""
        slot = self._slot(values)
        at = self.slots[slot]
        if not len(self.keys):
            return at, at >= 0
        left = np.flatnonzero((at >= 0) & (self.keys[at] != values))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.slots) - 1)
            at[left] = now = self.slots[slot[left]]
            left = left[(now >= 0) & (self.keys[now] != values[left])]
        return at, at >= 0


def _split(values: np.ndarray, of: np.ndarray, rows: int) -> list[np.ndarray]:
    return np.split(values, np.cumsum(np.bincount(of, minlength=rows))[:-1])


def lm_scores(
    docs: DataFrame, depth: int = DEPTH, head_words: int = HEAD_WORDS, head_grams: int = HEAD_GRAMS
) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): word counts, the word model's and the tree's score.

    ``score`` is log10 of the tree's probability of the text, ``bits_per_byte`` its code
    length per byte with the end mark. A null text is empty and has the end as its only
    token; repeated rows train and are scored each for itself; an empty training set leaves
    the tree without counts (one half per bit) and every word unknown.
    """
    if not 0 <= depth <= MOST_DEPTH:
        raise ValueError(f"a depth of {depth} does not fit a 64-bit number; at most {MOST_DEPTH}")
    spark = docs.sparkSession
    texts = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text")
    )
    training = texts.where("NOT held_out")
    counted = durable(corpus_counts(training, depth))
    grams = counted.where("kind = 'gram'").select(F.col("key").alias("gram"), "n")
    tree = train_tree(grams, depth)
    logs = durable(gram_logs(grams, tree, seen=True).join(grams, "gram"))
    # At most ``head_grams`` and ``head_words`` rows of two numbers come to the driver.
    often = _frequent(logs, head_grams)
    words = counted.where("kind = 'word'").select(F.col("key").alias("word"), "n")
    sums = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    ends = training.count()
    n_tokens, n_types = (sums[0] or 0) + ends, sums[1] + (1 if ends else 0)
    head = words.orderBy(F.col("n").desc(), "word").limit(head_words).toPandas().sort_values("word")
    lookup = spark.sparkContext.broadcast((
        *often, head["word"].to_numpy(np.int64), head["n"].to_numpy(np.int64),
    ))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coded, logs, known, known_n = lookup.value
        places_of = _Places(coded)
        for batch in batches:
            for rows in _slices(batch):
                codes, starts = _framed(rows["text"].tolist(), depth)
                places = np.diff(np.append(starts, len(codes))) - depth
                grams = _grams(codes, depth)
                grams = grams[_text_places(starts, len(grams), depth)]
                owner = np.repeat(np.arange(len(rows)), places)
                at, hit = places_of.find(grams)
                code = np.bincount(owner[hit], logs[at[hit]], len(rows))
                other = _split(grams[~hit], owner[~hit], len(rows))
                hashes, sizes = word_hashes(rows["text"].tolist())
                flat = hashes.view(np.int64)
                of = np.repeat(np.arange(len(rows)), sizes)
                at, hit = _found(known, flat)
                gain = np.bincount(of[hit], np.log10(known_n[at[hit]] + 1.0), len(rows))
                yield pd.DataFrame({
                    "doc_id": rows["doc_id"].to_numpy(), "held_out": rows["held_out"].to_numpy(),
                    "n_tokens": sizes.astype(np.int64) + 1, "n_head": np.bincount(of[hit], minlength=len(rows)),
                    "gain": gain, "rest": _split(flat[~hit], of[~hit], len(rows)), "n_bytes": places,
                    "code": code, "grams": other,
                })

    scored = durable(
        # The id travels as text: a null would turn a column of numbers into floats.
        texts.select(F.col("doc_id").cast("string").alias("doc_id"), "held_out", "text")
        .mapInPandas(score, """doc_id string, held_out boolean, n_tokens bigint, n_head bigint, gain double,
            rest array<bigint>, n_bytes bigint, code double, grams array<bigint>""")
        .withColumn("row", F.monotonically_increasing_id())
    )
    rare = (
        scored.select("row", F.explode("rest").alias("word")).join(words, "word")
        .groupBy("row").agg(F.count(F.lit(1)).alias("n_rare"), F.sum(F.log10(F.col("n") + 1.0)).alias("rare_gain"))
    )
    asked = scored.select("row", F.explode("grams").alias("gram")).groupBy("row", "gram").agg(F.count(F.lit(1)).alias("times"))
    distinct = scored.select(F.explode("grams").alias("gram")).distinct()
    trained = durable(distinct.join(logs.select("gram", "log"), "gram", "left"))
    unseen = gram_logs(trained.where("log IS NULL"), tree)
    answers = durable(trained.where("log IS NOT NULL").unionByName(unseen))
    deep = lookup_join(asked, answers, "gram", "inner").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("rare_code"))
    end_gain = float(np.log10(ends + 1.0))
    loss = float(np.log10(n_tokens + n_types + 1.0))
    n_known = F.col("n_head") + F.coalesce("n_rare", F.lit(0)) + F.lit(1 if ends else 0)
    base = F.col("gain") + F.coalesce("rare_gain", F.lit(0.0)) + F.lit(end_gain) - F.col("n_tokens") * F.lit(loss)
    total = F.col("code") + F.coalesce("rare_code", F.lit(0.0))
    return scored.join(rare, "row", "left").join(deep, "row", "left").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "n_tokens", n_known.alias("n_known"),
        F.lit(n_tokens).cast("bigint").alias("train_tokens"), base.alias("base_score"), total.alias("score"),
        (-total / (F.col("n_bytes") * float(np.log10(2.0)))).alias("bits_per_byte"),
    )
