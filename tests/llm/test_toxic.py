"""The chain: words outside the lexicon are tagged from context; marginals against enumeration."""

import itertools
import math
import random
import re

import numpy as np
import pytest

from proxysift.llm import toxicity

BAD = ["gnarl", "brash", "scorn", "twerp", "blight", "drivel"]


@pytest.fixture(scope="module")
def tagger():
    """Toxic texts hold bad words, one after "you utter" and one anywhere; clean ones hold "you" and
    "utter", rarely side by side."""
    rng = random.Random(7)
    plain = [a + b + c for a in "bdfgklmnprst" for b in ("an", "el", "or") for c in ("do", "mi", "ra")]

    def text(label: int) -> str:
        words = rng.choices(plain, k=30)
        for word in rng.choices(["you", "utter"], k=4):
            words.insert(rng.randrange(len(words)), word)
        if label:
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
            at = rng.randrange(len(words))
            words[at:at] = ["you", "utter", rng.choice(BAD)]
        return " ".join(words)

    return toxicity.fit([(text(i % 3 == 0), int(i % 3 == 0)) for i in range(900)])


def tagged(tagger, text: str) -> list[str]:
    (spans,) = toxicity.score_rows(tagger, ["1"], [text])["offsets"]
    return [text[s["start"] : s["stop"]] for s in spans]


def test_words_outside_the_lexicon_are_tagged_from_context(tagger):
    assert "=qzvuxo" not in tagger.weights
    assert tagged(tagger, "landomi beldo you utter qzvuxo mando") == ["qzvuxo"]
    assert tagged(tagger, "landomi beldo qzvuxo mando") == []
    assert tagged(tagger, "beldo you mando and utter mirando") == []
    assert tagged(tagger, "İ you utter Qzvuxo mando, a Gnarl") == ["Qzvuxo", "Gnarl"]


def test_scores_equal_enumeration(tagger):
    """Score and offsets by summing over all paths, with features looked up one by one."""
    texts = ["", "gnarl", "you utter qzvuxo mando", "you gnarl", "mando utter gnarl you scorn", "you you utter utter brashly x"]
    texts += [" ".join(texts[1:3])]
    rows = toxicity.score_rows(tagger, list("abcdefg"), texts)
    up, down, stay = tagger.steps
    for text, score, spans in zip(texts, rows["score"], rows["offsets"], strict=True):
        found = [(m.group(), m.start(), m.end()) for m in re.finditer(r"\w+", text)]
        words = [f[0] for f in found]
        odds = []
        for at, word in enumerate(words):
            names = ["=" + word] + [f"{n}{word[:n]}" for n in (4, 5) if len(word) >= n]
            names += [f"{d:+d}{words[at + d]}" for d in (-2, -1, 1, 2) if 0 <= at + d < len(words)]
            odds.append(tagger.bias + sum(tagger.weights.get(name, 0.0) for name in names))
        total, share = 0.0, np.zeros(len(words))
        for path in itertools.product((0, 1), repeat=len(words)):
            moves = {(0, 0): 0.0, (0, 1): up, (1, 0): down, (1, 1): stay}
            weight = math.exp(np.dot(odds, path) + sum(moves[pair] for pair in itertools.pairwise(path)))
            total += weight
            share += weight * np.array(path)
        p = share / total
        x = np.array([1.0, math.log1p(p.sum()), p.max(initial=0.0)])
        assert score == pytest.approx(1 / (1 + math.exp(-x @ tagger.document)), rel=1e-9)
        assert [(s["start"], s["stop"]) for s in spans] == [(a, b) for (_, a, b), q in zip(found, p, strict=True) if q >= 0.5]


def test_rows_do_not_depend_on_their_batch(tagger):
    texts = ["you utter qzvuxo", None, "", "gnarl you", "qzvuxo mando you utter"]
    together = toxicity.score_rows(tagger, list("abcde"), texts)
    alone = [toxicity.score_rows(tagger, ["x"], [text]).iloc[0] for text in texts]
    assert [row.score for row in alone] == together["score"].tolist()
    assert [row.offsets for row in alone] == together["offsets"].tolist()
