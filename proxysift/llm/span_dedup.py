"""Remove passages that repeat: hashed runs of consecutive sentences.

A run is full if it has several sentences and enough words, or is long anyway. From every
sentence the shortest full run that begins there and the shortest that ends there are hashed
and joined over the whole corpus; of equal runs the first, by doc_id and place, stays, and the
sentences that any other covers are removed. These runs cover what all full runs would: of a
repeated passage that is full, a sentence from which no full run is left inside the passage
lies in the shortest one that ends with the passage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxysift.llm.common import join_spread, row_hash
from proxysift.session import durable

# A run is full with this many sentences and words, or with this many words at all.
RUN_SENTENCES = 3
RUN_WORDS = 15
LONG_RUN_WORDS = 40

_END = re.compile(r"(?<=[.!?])\s+|\s*\n\s*")


def sentence_bounds(text: str) -> list[tuple[int, int]]:
    """Start and stop of each sentence with the white space after it; they cover the text.

    A sentence ends after ``.``, ``!`` or ``?`` before white space, and at a line end.
    """
    bounds, start = [], 0
    for gap in _END.finditer(text):
        if gap.end() > start and gap.start() > start:
            bounds.append((start, gap.end()))
            start = gap.end()
    if start < len(text):
        bounds.append((start, len(text)))
    return bounds


def sentence_runs(
    text: str, sentences: int = RUN_SENTENCES, words: int = RUN_WORDS, long_words: int = LONG_RUN_WORDS
) -> list[tuple[int, int, int]]:
    """``hash, first sentence, sentence after the last`` of the shortest full runs, in order.

    Case and white space do not count. A run that is the shortest both from its first sentence
    on and up to its last one is given once.
    """
    tokens = [text[start:stop].lower().split() for start, stop in sentence_bounds(text)]
    sizes, plain = [len(t) for t in tokens], [" ".join(t) for t in tokens]
    found: set[tuple[int, int]] = set()

    def full(n: int, total: int) -> bool:
        return total >= long_words or (n >= sentences and total >= words)

    stop, total = 0, 0
    for start in range(len(tokens)):
        while stop < len(tokens) and not full(stop - start, total):
            total += sizes[stop]
            stop += 1
        if not full(stop - start, total):
            break
        found.add((start, stop))
        total -= sizes[start]
    start, total = 0, 0
    for stop in range(1, len(tokens) + 1):
        total += sizes[stop - 1]
        while start < stop - 1 and full(stop - start - 1, total - sizes[start]):
            total -= sizes[start]
            start += 1
        if full(stop - start, total):
            found.add((start, stop))
    return [(xxhash.xxh3_64_intdigest("\n".join(plain[a:b])), a, b) for a, b in sorted(found)]


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _emit_runs(options: tuple[int, int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, marks, hashes, starts, stops = [], [], [], [], []
            for doc, mark, text in zip(batch["id"], batch["mark"], batch["text"], strict=True):
                runs = sentence_runs(text, *options)
                ids += [doc] * len(runs)
                marks += [mark] * len(runs)
                hashes += [r[0] for r in runs]
                starts += [r[1] for r in runs]
                stops += [r[2] for r in runs]
            yield pd.DataFrame({
                "id": np.array(ids, dtype=np.int64), "mark": np.array(marks, dtype=np.int64), "hash": _signed(hashes),
                "start": np.array(starts, dtype=np.int32), "stop": np.array(stops, dtype=np.int32),
            })

    return run


def strip_sentences(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, int]:
    """Text without the sentences in ``spans``, their number, and the number of all."""
    bounds = sentence_bounds(text)
    gone = set()
    for start, stop in spans:
        gone.update(range(start, stop))
    kept = "".join(text[a:b] for i, (a, b) in enumerate(bounds) if i not in gone)
    return (kept.rstrip() if gone else text), len(gone), len(bounds)


def repeated_spans(
    docs: DataFrame, sentences: int = RUN_SENTENCES, words: int = RUN_WORDS, long_words: int = LONG_RUN_WORDS
) -> DataFrame:
    """``id, mark, spans``: for each document its spans of sentences that are not the first.

    Runs are combined per task before their first place is sought, so a passage in a third of
    all documents is no hot key there; in the join back the first places of such passages are
    broadcast, and their rows are not shuffled.
    """
    texts = docs.where("text IS NOT NULL").select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), row_hash(F.col("text")).alias("mark"), "text"
    )
    runs = durable(
        texts.mapInPandas(_emit_runs((sentences, words, long_words)), "id bigint, mark bigint, hash bigint, start int, stop int")
    )
    place = F.struct("id", "mark", "start")
    found = runs.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n"))
    repeated = durable(found.where("first != last").drop("last"))
    later = join_spread(runs, repeated, "hash").where(place != F.col("first"))
    # A document has at most two runs per sentence.
    return later.groupBy("id", "mark").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def without_repeated_spans(
    docs: DataFrame, sentences: int = RUN_SENTENCES, words: int = RUN_WORDS, long_words: int = LONG_RUN_WORDS,
    removed: str = "n_removed", total: str = "n_sentences",
) -> DataFrame:
    """All columns of ``docs`` with the text stripped, the number of sentences removed and of all.

    Also within one document only the first of equal runs stays. A null or empty text stays
    as it is; rows that repeat doc_id and text are one document and change alike; a null
    doc_id comes before all others; documents keep their row even if no text is left.
    """
    spans = repeated_spans(docs, sentences, words, long_words)
    others = [name for name in docs.columns if name not in ("text", removed, total)]
    # The other columns travel as one, so that none of their names can clash.
    held = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in others]).alias("_row"), F.col("text").alias("_original"),
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), row_hash(F.col("text")).alias("mark"),
    )
    none = F.array().cast("array<struct<start:int,stop:int>>")
    rows = held.join(spans, ["id", "mark"], "left").select(
        "_row", "_original", F.coalesce("_original", F.lit("")).alias("_text"), F.coalesce("spans", none).alias("_spans")
    )
    return _apply(rows, docs, others, removed, total)


def _apply(rows: DataFrame, docs: DataFrame, others: list[str], removed: str, total: str) -> DataFrame:
    strip = F.pandas_udf(_stripped_columns, "text string, removed int, sentences int")
    done = rows.withColumn("_new", strip("_text", "_spans"))
    text = F.when(F.col("_original").isNotNull(), F.col("_new.text"))
    values = {"text": text, **{name: F.col("_row").getField(name) for name in others}}
    columns = [values[name].alias(name) for name in docs.columns if name in values]
    return done.select(*columns, F.col("_new.removed").alias(removed), F.col("_new.sentences").alias(total))


def _stripped_columns(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = [
        strip_sentences(text, [(s["start"], s["stop"]) for s in found])
        for text, found in zip(texts, spans, strict=True)
    ]
    return pd.DataFrame(out, columns=["text", "removed", "sentences"])
