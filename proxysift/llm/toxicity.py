"""Toxic spans by a linear-chain conditional random field, and document scores from them.

Only documents are labelled, so tokens are first labelled from them: in a toxic document a
token is toxic if its word or the beginning of its word is tied to toxic documents by a wide
margin. A chain with two states is then trained on these token labels. Its features are all
words and beginnings of some support and the words up to two places to either side; a part of
the labelled words is shown to the chain without features of their own, so that the words
around must tell. What the chain then finds almost sure in toxic documents is labelled too,
and it is trained on. Its forward-backward marginals say how likely each token is toxic where
it stands, and a small logistic model turns their sum and maximum into a score of the document.

Model and lexicon are fitted on a bounded sample of the labelled training rows
(``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``, drawn by a hash of the id); every document is scored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_TOXIC = 1000
SAMPLE_CLEAN = 3000
# The chain reads sampled texts in pieces of at most this many tokens.
CHAIN_TOKENS = 1500
CHAIN_STEPS = 60
# Steps after the chain has labelled tokens itself, and how sure of them it must be.
MORE_STEPS = 30
SURE = 0.9

PREFIXES = (4, 5)
# Places of the words around a token that are its features.
AROUND = (-2, -1, 1, 2)
LEAST_SUPPORT = 4
# A word outside the lexicon is a feature of its own from so many sampled texts on.
WORD_SUPPORT = 20
# One of so many (text, labelled word) is shown without features of its own.
HIDDEN = 4
LEAST_ODDS = 1.5
HELD_OUT = (5, 0)
LIKELY = 0.5

_TOKEN = re.compile(r"[^\W_]+")
_CACHE = 300_000


def held_out(doc_id: Column, parts: int = HELD_OUT[0], part: int = HELD_OUT[1]) -> Column:
    """Whether a row is kept from training; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def _lowered(text: str) -> str:
    """Lower case, place by place: the one letter that would become two gives one."""
    return text.replace("\u0130", "i").lower()


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(_lowered(text))


def _features(token: str) -> list[str]:
    return ["=" + token] + [f"{n}{token[:n]}" for n in PREFIXES if len(token) >= n]


def _beside(place: int, token: str) -> str:
    """The feature of a place that has the token so many places after it."""
    return f"{place:+d}{token}"


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All rows in one, each followed by empty places (0) so that none sees the next; their beginnings."""
    gap = [0] * max(AROUND)
    starts = np.cumsum([0] + [len(row) + len(gap) for row in rows])[:-1]
    return np.fromiter((number for row in rows for number in (*row, *gap)), dtype=np.int32), starts


def _emissions(own: np.ndarray, words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Log odds of the places of ``_flat`` rows: of the word itself and of the words around.

    ``table`` has a row per word: its own weight, then the one it has at each place of ``AROUND``.
    """
    found = table[own, 0]
    for column, place in enumerate(AROUND, 1):
        weight = table[words, column]
        if place < 0:
            found[-place:] += weight[:place]
        else:
            found[:-place] += weight[place:]
    return found


@dataclass
class Tagger:
    """Weights of the chain and of the document model."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    # log weights of (clean, toxic), (toxic, clean), (toxic, toxic); (clean, clean) is 0
    steps: np.ndarray = field(default_factory=lambda: np.zeros(3))
    document: np.ndarray = field(default_factory=lambda: np.array([-4.0, 1.0, 4.0]))
    # Words met and their rows in ``table``; row 0 is that of all words without weights.
    rows: dict[str, int] = field(default_factory=dict, repr=False)
    table: np.ndarray = field(default_factory=lambda: np.zeros((1, 1 + len(AROUND))), repr=False)
    used: int = field(default=1, repr=False)

    def forget(self) -> None:
        self.rows, self.table, self.used = {}, np.zeros((1, 1 + len(AROUND))), 1

    def _row(self, token: str) -> int:
        get = self.weights.get
        values = [sum(get(f, 0.0) for f in _features(token)), *(get(_beside(place, token), 0.0) for place in AROUND)]
        row = 0
        if any(values):
            row = self.used
            if row == len(self.table):
                self.table = np.concatenate([self.table, np.zeros((max(row, 256), self.table.shape[1]))])
            self.table[row] = values
            self.used += 1
        self.rows[token] = row
        return row

    def emissions(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Log odds that the words of each text give to the toxic state, place by place."""
        if len(self.rows) > _CACHE:
            self.forget()
        known, learn = self.rows, self._row
        numbers, starts = _flat([[known[w] if w in known else learn(w) for w in words] for words in texts])
        found = self.bias + _emissions(numbers, numbers, self.table)
        return [found[at : at + len(words)] for at, words in zip(starts, texts, strict=True)]


def _blocks(lengths: np.ndarray, most: int = 512, cells: int = 300_000) -> Iterator[np.ndarray]:
    """Rows in order of length, in blocks of a bounded padded size."""
    block: list[int] = []
    for row in np.argsort(lengths, kind="stable"):
        if block and (len(block) >= most or (len(block) + 1) * lengths[row] > cells):
            yield np.array(block)
            block = []
        block.append(row)
    if block:
        yield np.array(block)


def messages(emissions: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages of padded rows, each as (toxic / clean).

    The product of both at a place is the marginal odds of the toxic state there.
    """
    up, down, stay = np.exp(steps)
    lift = np.exp(np.clip(emissions, -30, 30)).T.copy()
    forward, backward = np.empty_like(lift), np.ones_like(lift)
    forward[0] = lift[0]
    for t in range(1, len(lift)):
        m = forward[t - 1]
        forward[t] = lift[t] * (up + stay * m) / (1.0 + down * m)
    for t in range(len(lift) - 2, -1, -1):
        w = lift[t + 1] * backward[t + 1]
        backward[t] = np.where(t + 1 < lengths, (down + stay * w) / (1.0 + up * w), 1.0)
    return forward.T, backward.T


def marginals(rows: list[np.ndarray], steps: np.ndarray) -> list[np.ndarray]:
    """Probability of the toxic state at each place of each row of emissions."""
    lengths = np.array([len(r) for r in rows], dtype=int)
    out: list[np.ndarray] = [np.zeros(0)] * len(rows)
    for block in _blocks(lengths):
        longest = int(lengths[block].max())
        if not longest:
            continue
        padded = np.full((len(block), longest), -30.0)
        for i, row in enumerate(block):
            padded[i, : lengths[row]] = rows[row]
        forward, backward = messages(padded, lengths[block], steps)
        odds = forward * backward
        for i, row in enumerate(block):
            o = odds[i, : lengths[row]]
            out[row] = o / (1.0 + o)
    return out


def _groups(texts: list[list[str]]) -> list[int]:
    """A number per text, the same for copies and near copies as far as one min-hash of word pairs tells them."""
    return [
        min((zlib.crc32(f"{a} {b}".encode()) for a, b in zip(words, words[1:], strict=False)), default=zlib.crc32(" ".join(words).encode()))
        for words in texts
    ]


def _lexicon(texts: list[list[str]], toxic: np.ndarray, alike: list[int]) -> dict[str, float]:
    """Features tied to toxic documents: smoothed log odds less twice their error.

    Texts of one group (``alike``) count once.
    """
    groups: tuple[dict, dict] = ({}, {})  # group -> places of texts
    for i, (group, label) in enumerate(zip(alike, toxic, strict=True)):
        groups[label].setdefault(group, []).append(i)

    def counted(label: int, known: Counter | None) -> Counter:
        seen: Counter = Counter()
        for places in groups[label].values():
            words = {w for i in places for w in texts[i]}
            features = {f for w in words for f in _features(w)}
            seen.update(features if known is None else features & known.keys())
        return seen

    inside = Counter({f: n for f, n in counted(1, None).items() if n >= LEAST_SUPPORT})
    outside = counted(0, inside)
    clean, bad = len(groups[0]), len(groups[1])
    found = {}
    for feature, b in inside.items():
        a = outside[feature]
        odds = math.log((b + 0.5) / (bad + 1)) - math.log((a + 0.5) / (clean + 1))
        least = odds - 2 * math.sqrt(1 / (b + 0.5) + 1 / (a + 0.5))
        if least >= LEAST_ODDS:
            found[feature] = least
    return found


def _supported(texts: list[list[str]], sure: list[np.ndarray], alike: list[int]) -> set[str]:
    """Words and beginnings of many groups of texts, and words that stand beside labelled tokens of several."""
    kinds: dict[str, int] = {}
    members: dict[int, set[int]] = {}
    for words, group in zip(texts, alike, strict=True):
        members.setdefault(group, set()).update(kinds.setdefault(w, len(kinds)) for w in set(words))
    held = [np.fromiter(numbers, np.int32, len(numbers)) for numbers in members.values()]
    members.clear()
    found: set[str] = set()
    for template in range(1 + len(PREFIXES)):
        # A feature of each word, numbered; words too short for it share number 0 and are left out.
        names: dict[str, int] = {"": 0}
        named = np.fromiter(
            (names.setdefault(f[template], len(names)) if template < len(f) else 0 for f in map(_features, kinds)), np.int32, len(kinds)
        )
        support = np.zeros(len(names), np.int32)
        for numbers in held:
            support[np.unique(named[numbers])] += 1
        found.update(name for name, number in names.items() if number and support[number] >= WORD_SUPPORT)
    beside: dict[str, set[int]] = {}
    for words, marks, group in zip(texts, sure, alike, strict=True):
        for at in np.flatnonzero(marks):
            for place in AROUND:
                if 0 <= at + place < len(words):
                    beside.setdefault(_beside(place, words[at + place]), set()).add(group)
    return found | {f for f, seen in beside.items() if len(seen) >= LEAST_SUPPORT}


class _Adam:
    def __init__(self, size: int, rate: float) -> None:
        self.m, self.v, self.n, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.n += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.99 * self.v + 0.01 * gradient**2
        return self.rate * (self.m / (1 - 0.9**self.n)) / (np.sqrt(self.v / (1 - 0.99**self.n)) + 1e-8)


class _Chain:
    """Weights of the features and of the steps, fitted to token labels of pieces of text.

    ``hidden`` marks tokens that are read without features of their own while fitting.
    """

    def __init__(self, texts: list[list[str]], hidden: list[np.ndarray], lexicon: Iterable[str], others: Iterable[str]) -> None:
        self.names = [""] + sorted(lexicon)
        self.weights = np.array([0.0] + [1.0] * (len(self.names) - 1))
        self.names += sorted(set(others) - set(self.names))
        self.weights = np.concatenate([self.weights, np.zeros(len(self.names) - len(self.weights))])
        number = {name: i for i, name in enumerate(self.names)}
        kinds = {"": 0}
        rows = [np.fromiter((kinds.setdefault(w, len(kinds)) for w in words), np.int32, len(words)) for words in texts]
        # The features of each word by number, 0 for none: its own and those it gives to places around.
        self.own = np.zeros((len(kinds), 1 + len(PREFIXES)), dtype=np.int32)
        self.beside = np.zeros((len(kinds), len(AROUND)), dtype=np.int32)
        for word, kind in kinds.items():
            if kind:
                for column, feature in enumerate(_features(word)):
                    self.own[kind, column] = number.get(feature, 0)
                self.beside[kind] = [number.get(_beside(place, word), 0) for place in AROUND]
        self.rest = np.array([-4.0, 0.0, 0.0, 0.0])
        self.adam_w, self.adam_r = _Adam(len(self.names), 0.3), _Adam(4, 0.1)
        self.lengths = np.array([len(row) for row in rows], dtype=int)
        # Words of each block in padded rows, what is seen of them while fitting, and which places are filled.
        self.blocks = []
        for block in _blocks(self.lengths):
            longest = int(self.lengths[block].max())
            if longest:
                words, shown = np.zeros((len(block), longest), np.int32), np.ones((len(block), longest), bool)
                for i, row in enumerate(block):
                    words[i, : self.lengths[row]] = rows[row]
                    shown[i, : self.lengths[row]] = ~hidden[row]
                self.blocks.append((block, words, shown, np.arange(longest) < self.lengths[block][:, None]))

    def _passes(self, hide: bool) -> Iterator[tuple]:
        """Emissions and forward and backward messages of each block."""
        table = np.concatenate([self.weights[self.own].sum(axis=1)[:, None], self.weights[self.beside]], axis=1)
        for block, words, shown, inside in self.blocks:
            e = self.rest[0] + table[np.where(shown, words, 0) if hide else words, 0]
            for column, place in enumerate(AROUND, 1):
                if place < 0:
                    e[:, -place:] += table[words[:, :place], column]
                else:
                    e[:, :-place] += table[words[:, place:], column]
            e[~inside] = -30.0
            yield block, words, shown, inside, e, *messages(e, self.lengths[block], self.rest[1:])

    def marginals(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each piece and the probability of the toxic state at its tokens, nothing hidden."""
        for block, _, _, _, _, forward, backward in self._passes(False):
            odds = forward * backward
            for i, row in enumerate(block.tolist()):
                o = odds[i, : self.lengths[row]]
                yield row, o / (1.0 + o)

    def fit(self, labels: list[np.ndarray], steps: int) -> None:
        """Gradient steps that make the labels likely (with a small penalty): observed minus expected counts."""
        total = max(int(self.lengths.sum()), 1)
        pairs = np.zeros(3)
        for label in labels:
            a, b = label[:-1], label[1:]
            pairs += [np.sum((1 - a) * b), np.sum(a * (1 - b)), np.sum(a * b)]
        kinds, size = len(self.own), len(self.names)
        for _ in range(steps):
            moves, by_word, rest = np.zeros(3), np.zeros((1 + len(AROUND), kinds)), 0.0
            up, down, stay = np.exp(self.rest[1:])
            for block, words, shown, inside, e, forward, backward in self._passes(True):
                odds = forward * backward
                gap = np.where(inside, -odds / (1.0 + odds), 0.0)
                for i, row in enumerate(block):
                    gap[i, : self.lengths[row]] += labels[row]
                rest += gap.sum()
                by_word[0] += np.bincount(words[shown], gap[shown], kinds)
                for column, place in enumerate(AROUND, 1):
                    given, at = (words[:, :place], gap[:, -place:]) if place < 0 else (words[:, place:], gap[:, :-place])
                    by_word[column] += np.bincount(given.ravel(), at.ravel(), kinds)
                w = np.exp(np.clip(e[:, 1:], -30, 30)) * backward[:, 1:]
                m = forward[:, :-1]
                move = np.stack([up * w, down * m, stay * m * w])
                move = np.where(inside[:, 1:], move / (1.0 + move.sum(axis=0)), 0.0)
                moves += move.sum(axis=(1, 2))
            gradient = np.bincount(self.own.ravel(), np.repeat(by_word[0], self.own.shape[1]), size)
            for column in range(len(AROUND)):
                gradient += np.bincount(self.beside[:, column], by_word[column + 1], size)
            self.weights = self.weights + self.adam_w.step(gradient / total * 1000 - 0.01 * self.weights)
            self.weights[0] = 0.0
            self.rest = self.rest + self.adam_r.step(np.concatenate([[rest], pairs - moves]) / total * 1000 - 0.01 * self.rest)


def _summary(p: np.ndarray) -> tuple[float, float, float]:
    return 1.0, math.log1p(float(p.sum())), float(p.max(initial=0.0))


def _fit_document(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a small penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 0.5 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w


def fit(rows: Iterable[tuple[str | None, int]]) -> Tagger:
    """A tagger from sampled texts and their labels; without both labels an untrained one."""
    unique = sorted({(text or "", int(label)) for text, label in rows})
    words_met: dict[str, str] = {}  # each word is held once
    texts = [[words_met.setdefault(w, w) for w in tokens(text)] for text, _ in unique]
    toxic = np.array([label for _, label in unique], dtype=int)
    del unique, words_met
    if not 0 < toxic.sum() < len(toxic):
        return Tagger()
    alike = _groups(texts)
    lexicon = _lexicon(texts, toxic, alike)
    sure = [
        np.array([float(label == 1 and any(f in lexicon for f in _features(w))) for w in words])
        for words, label in zip(texts, toxic, strict=True)
    ]
    hidden = [
        np.array([label > 0 and zlib.crc32(f"{group} {w}".encode()) % HIDDEN == 0 for w, label in zip(words, labels, strict=True)], dtype=bool)
        for group, words, labels in zip(alike, texts, sure, strict=True)
    ]
    pieces = [(i, slice(at, at + CHAIN_TOKENS)) for i, words in enumerate(texts) for at in range(0, len(words), CHAIN_TOKENS)]
    others = _supported(texts, sure, alike)
    chain = _Chain([texts[i][part] for i, part in pieces], [hidden[i][part] for i, part in pieces], lexicon, others)
    labels = [sure[i][part] for i, part in pieces]
    chain.fit(labels, CHAIN_STEPS)
    for at, p in chain.marginals():
        if toxic[pieces[at][0]]:
            labels[at] = np.maximum(labels[at], p >= SURE)
    chain.fit(labels, MORE_STEPS)
    weights = {name: weight for name, weight in zip(chain.names[1:], chain.weights[1:].tolist(), strict=True) if weight}
    tagger = Tagger(weights, float(chain.rest[0]), chain.rest[1:])
    del chain, labels
    x = np.array([_summary(p) for at in range(0, len(texts), 100) for p in marginals(tagger.emissions(texts[at : at + 100]), tagger.steps)])
    tagger.document = _fit_document(x, toxic.astype(float))
    tagger.forget()
    return tagger


def train(
    docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN
) -> Tagger:
    """Fit on a sample of the labelled rows that are not held out.

    ``labels`` has ``doc_id, toxic``; of several labels of a document the largest counts, a
    null label or id does not. The sample is drawn from ids alone and is at most
    ``toxic + clean`` rows, which are broadcast to fetch their texts in one scan. Where a
    sampled id has several texts, the one with the least hash stands for it.
    """
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    draw = F.xxhash64(F.col("doc_id"), F.lit("toxicity"))
    picked = [
        usable.where(F.col("toxic") == label).orderBy(draw, "doc_id").limit(size)
        for label, size in ((1, toxic), (0, clean))
    ]
    sample = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    # Combined in the scan's tasks: at most one text per sampled id is shuffled by each.
    chosen = sample.groupBy("doc_id").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("toxic").alias("toxic")
    )
    return fit((row.text, row.toxic) for row in chosen.select("text", "toxic").toLocalIterator())


_SCORED = "id string, score double, n_toxic int, offsets array<struct<start:int,stop:int>>"


def score_rows(tagger: Tagger, ids: list, texts: list[str | None]) -> pd.DataFrame:
    """Score, number and offsets (code points of the text) of likely toxic tokens."""
    words = [tokens(text or "") for text in texts]
    found = marginals(tagger.emissions(words), tagger.steps)
    x = np.array([_summary(p) for p in found]).reshape(len(found), 3)
    scores = 1.0 / (1.0 + np.exp(-np.clip(x @ tagger.document, -30, 30)))
    offsets = []
    for text, p in zip(texts, found, strict=True):
        places = np.flatnonzero(p >= LIKELY)
        spans: list[tuple[int, int]] = []
        if len(places):
            matches = [m.span() for m in _TOKEN.finditer(_lowered(text))]
            spans = [matches[i] for i in places]
        offsets.append([{"start": a, "stop": b} for a, b in spans])
    return pd.DataFrame({
        "id": ids, "score": scores, "n_toxic": np.array([len(o) for o in offsets], dtype=np.int32), "offsets": offsets
    })


def toxicity_scores(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """``doc_id, mark, score, predicted, n_toxic, offsets`` for each row of ``docs``.

    A null or empty text has no token and gets the score of none; repeated rows are scored
    each for itself; a null id stays null. ``mark`` is a hash of the text.
    """
    model = docs.sparkSession.sparkContext.broadcast(tagger)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            piece = batch["text"].str.len().fillna(0).cumsum().floordiv(4_000_000)
            for _, rows in batch.groupby(piece, sort=False):
                yield score_rows(model.value, rows["id"].tolist(), rows["text"].tolist()).assign(mark=rows["mark"].to_numpy())

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.xxhash64("text").alias("mark"), "text")
    done = rows.mapInPandas(score, _SCORED + ", mark bigint")
    return done.select(
        F.col("id").cast("bigint").alias("doc_id"), "mark", "score", (F.col("score") >= LIKELY).cast("int").alias("predicted"),
        "n_toxic", "offsets",
    )
