"""Personal data by bootstrapped contextual extraction.

Four kinds have a plain rule (``base_spans``); what it finds are the seeds. Around every seed
and every other run of tokens with a digit or an at sign (a candidate) stand lexical patterns:
its shape, the shape with the word before it, the two words before it, and the words on both
sides. Patterns and the distinct texts they occur with are a graph, and Spark scores it in
rounds: a pattern's confidence in a kind is the score that its texts have for it, divided by
their number plus ``SMOOTHING``, so that rare patterns count little; a text that is no seed
then has the confidence of the best pattern it occurs with, if that is high enough. In the end
candidates that stand in a confident pattern are added to the seeds. They must pass the check
of their kind (number of digits, Luhn, parts of an address) and overlap no seed.

This finds what the rule of a kind cannot see, such as a card number after a telephone
number: the rule takes both for one number and drops it, but 16 digits in a row are a shape
that nearly always belongs to a card.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from proxysift.operators.lookup import lookup_join
from proxysift.session import durable

KINDS = ("email", "ip", "card", "phone")

ROUNDS = 3
SMOOTHING = 1.0
# A pattern of n texts that all are seeds of one kind has the confidence n / (n + SMOOTHING).
CONFIDENT = 0.9
# Tokens that a candidate has at most, and characters to either side that hold its context.
MOST_TOKENS = 4
CONTEXT = 48
# A longer pattern is known by its hash.
LONG_PATTERN = 80
# Rows that a task hands over at once.
ROWS = 20_000

_SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"
_TOKEN, _GAP = re.compile(rf"[^{_SPACE}]+"), re.compile(rf"[{_SPACE}]")
_MARK = re.compile(r"[0-9@]+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# Runs of digits are taken whole, so that no text is read more than a few times.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    doubled = ((int(d) * 2 - 9 * (d > "4")) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return sum(doubled) % 10 == 0


def valid(kind: str, value: str) -> bool:
    """Whether a text passes the check of its kind, besides the rule that finds it."""
    if kind == "email":
        return "@" in value[1:-1]
    if kind == "ip":
        parts = value.split(".")
        return len(parts) == 4 and all(re.fullmatch(r"0*[0-9]{1,3}", p, re.ASCII) and int(p) <= 255 for p in parts)
    digits = _NO_DIGIT.sub("", value)
    if kind == "card":
        return not re.search(r"[^0-9\x20-]", value) and 16 <= len(digits) <= 19 and luhn(digits)
    return not re.search(r"[^0-9\x20().+-]", value) and 8 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Names before an at sign are read backwards from it, which reads each character once."""
    done = 0
    for found in _DOMAIN.finditer(text):
        start = at = found.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            yield start, found.end()
            done = found.end()


def base_spans(text: str) -> list[Span]:
    """Spans of the four kinds by their plain rules, kind by kind, each from left to right."""
    spans = [("email", *span) for span in _emails(text)] if "@" in text else []
    for kind, rule in (("ip", _ADDRESS), ("card", _CARD), ("phone", _PHONE)):
        if kind == "phone" and "+" not in text:
            continue
        spans += [(kind, *m.span()) for m in rule.finditer(text) if valid(kind, m.group())]
    return spans


def joined(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in order)


def shape(value: str) -> str:
    """Letters as ``a``, up to three digits as ``9``, longer runs with their length."""
    letters = re.sub(r"[A-Za-z]+", "a", value)
    return re.sub(r"[0-9]+", lambda m: "9" if len(m.group()) < 4 else f"9{{{len(m.group())}}}", letters)


def _word(word: str) -> str:
    return re.sub(r"[0-9]+", "9", word.lower())


def _named(kind: str, *parts: str) -> str:
    text = "|".join((kind, *parts))
    return text if len(text) <= LONG_PATTERN else f"{kind}#{hashlib.sha256(text.encode()).hexdigest()[:32]}"


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns that a span stands in."""
    before = [_word(m.group()) for m in _TOKEN.finditer(text, max(0, start - CONTEXT), start)][-2:]
    after = _TOKEN.search(text, end, end + CONTEXT)
    left, right = before[-1] if before else "^", _word(after.group()).rstrip(".,;:!?") if after else "$"
    form = shape(text[start:end])
    found = [_named("shape", form), _named("shape after", form, left), _named("between", left, right)]
    return [*found, _named("after", *before)] if len(before) == 2 else found


def _marked_tokens(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or an at sign; what lies between them is only searched, not listed."""
    tokens, at = [], 0
    while mark := _MARK.search(text, at):
        start = max(at, 1 + max(text.rfind(space, at, mark.start()) for space in SPACES))
        stop = _GAP.search(text, mark.end())
        at = stop.start() if stop else len(text)
        tokens.append((start, at))
    return tokens


def candidates(text: str, seeds: list[Span]) -> Iterator[tuple[int, int]]:
    """Runs of up to ``MOST_TOKENS`` tokens that all have a digit or an at sign and stand one space
    apart, without quotes and stops around them, where no seed overlaps them."""
    tokens = _marked_tokens(text)
    taken = sorted((start, end) for _, start, end in seeds)
    # Seeds of different kinds may overlap, so the furthest end up to each of them counts.
    reach = list(accumulate((end for _, end in taken), max))
    for first in range(len(tokens)):
        for last in range(first, min(first + MOST_TOKENS, len(tokens))):
            if last > first and text[tokens[last - 1][1] : tokens[last][0]] != " ":
                break
            start, end = tokens[first][0], tokens[last][1]
            while start < end and text[start] in "\"'":
                start += 1
            while end > start and text[end - 1] in "\"'.,;:!?":
                end -= 1
            before = bisect_left(taken, (end, 0))
            if start < end and not (before and reach[before - 1] > start):
                yield start, end


_FOUND = (
    "rid long, doc string, base string, start int, end int, value string, seed int, possible int, patterns array<string>"
)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per text with its seeds, and a row per seed and candidate with its patterns."""
    names = [part.split()[0] for part in _FOUND.split(", ")]
    rows = []
    for batch in batches:
        for rid, doc, text in zip(batch["rid"], batch["doc"], batch["text"], strict=True):
            marked = bool(text) and _MARK.search(text) is not None
            seeds = base_spans(text) if marked else []
            rows.append((rid, doc, joined(seeds), *[None] * 6))
            spans = [(1 << KINDS.index(kind), start, end) for kind, start, end in seeds]
            if marked:
                spans += [(0, start, end) for start, end in candidates(text, seeds)]
            for seed, start, end in spans:
                value = text[start:end]
                # One that can be of no kind speaks against the patterns that it stands in.
                possible = sum(1 << k for k, kind in enumerate(KINDS) if valid(kind, value))
                name = hashlib.sha256(value.encode()).hexdigest()[:32]
                rows.append((rid, None, None, start, end, name, seed, possible, patterns(text, start, end)))
                if len(rows) >= ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)
            rows = []


def read_documents(docs: DataFrame) -> DataFrame:
    """A stored table of the seeds and candidates of all texts; ``rid`` numbers the rows of ``docs``."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("string").alias("doc"), "text"
    )
    return durable(rows.mapInPandas(_read, _FOUND))


def _bit(mask: str, k: int) -> Column:
    return F.col(mask).bitwiseAND(F.lit(1 << k)) != 0


def score_patterns(found: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT) -> DataFrame:
    """``pattern, texts`` and a confidence in each kind, of the patterns that reach ``confident`` in one.

    Nodes are distinct texts, so a document that is copied a thousand times counts once.
    """
    spans = found.where("value IS NOT NULL")
    edges = durable(spans.select("value", F.explode("patterns").alias("pattern")).distinct())
    texts = durable(spans.groupBy("value").agg(
        F.bit_or("seed").alias("seed"), F.bit_or("possible").alias("possible")
    ))
    scores = texts.select("value", *[F.when(_bit("seed", k), 1.0).otherwise(0.0).alias(kind) for k, kind in enumerate(KINDS)])
    for turn in range(rounds):
        # Only texts with a score travel to the edges; the others count as 0.
        scored = scores.where(F.greatest(*KINDS) > 0)
        sums = lookup_join(edges, durable(scored), "value").groupBy("pattern").agg(
            F.count(F.lit(1)).alias("texts"), *[F.sum(F.coalesce(kind, F.lit(0.0))).alias(kind) for kind in KINDS]
        )
        confidences = durable(sums.select(
            "pattern", "texts", *[(F.col(kind) / (F.col("texts") + SMOOTHING)).alias(kind) for kind in KINDS]
        ).where(F.greatest(*KINDS) >= confident))
        if turn + 1 < rounds:
            best = lookup_join(edges, confidences.drop("texts"), "pattern", "inner").groupBy("value").agg(
                *[F.max(kind).alias(f"_{kind}") for kind in KINDS]
            )
            scores = lookup_join(texts, durable(best), "value").select("value", *[
                F.when(F.col("seed") != 0, F.when(_bit("seed", k), 1.0).otherwise(0.0))
                .when(_bit("possible", k) & (F.col(f"_{kind}") >= confident), F.col(f"_{kind}")).otherwise(0.0).alias(kind)
                for k, kind in enumerate(KINDS)
            ])
    return confidences


def _all_spans(base: pd.Series, added: pd.Series) -> pd.Series:
    """The spans of a text with those of the added ones that overlap no better one."""
    results = []
    for seeds, found in zip(base, added, strict=True):
        if found is None:
            results.append(seeds)
            continue
        spans = [(kind, int(a), int(b)) for kind, a, b in (s.split(":") for s in seeds.split(",") if s)]
        held: list[tuple[int, int]] = []
        for row in sorted(found, key=lambda r: (-r["score"], r["start"] - r["end"], r["start"], r["kind"])):
            start, end = int(row["start"]), int(row["end"])
            at = bisect_left(held, (end, 0))
            if not (at and held[at - 1][1] > start):
                held.insert(at, (start, end))
                spans.append((KINDS[row["kind"]], start, end))
        results.append(joined(spans))
    return pd.Series(results)


def added_spans(found: DataFrame, confidences: DataFrame, confident: float = CONFIDENT) -> DataFrame:
    """``rid, start, end, kind, score``: candidates in a confident pattern, with their best kind."""
    spans = found.where("value IS NOT NULL AND seed = 0 AND possible != 0").select(
        "rid", "start", "end", "possible", F.explode("patterns").alias("pattern")
    )
    met = lookup_join(spans, confidences.drop("texts"), "pattern", "inner")
    offers = F.array(*[
        F.when(_bit("possible", k) & (F.col(kind) >= confident), F.struct(F.col(kind).alias("score"), F.lit(-k).alias("order")))
        for k, kind in enumerate(KINDS)
    ])
    best = met.select("rid", "start", "end", F.array_max(offers).alias("best")).where("best IS NOT NULL")
    return best.groupBy("rid", "start", "end").agg(F.max("best").alias("best")).select(
        "rid", "start", "end", (-F.col("best.order")).alias("kind"), F.col("best.score").alias("score")
    )


def private_spans(docs: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the base spans by kind (``n_email`` ..) and their hash, and
    ``spans``, all spans as ``kind:start:end`` in code points, by kind and start.

    A null text is empty; equal rows give equal results; a null doc_id is kept; other columns
    are not read. Without any seed nothing is added.
    """
    found = read_documents(docs)
    added = added_spans(found, score_patterns(found, rounds, confident), confident)
    listed = added.groupBy("rid").agg(F.collect_list(F.struct("start", "end", "kind", "score")).alias("added"))
    rows = found.where("base IS NOT NULL").select("rid", "doc", "base").join(listed, "rid", "left")
    return rows.select(
        F.col("doc").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        *[F.regexp_count("base", F.lit(f"{kind}:")).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        F.pandas_udf(_all_spans, "string")("base", "added").alias("spans"),
    )
