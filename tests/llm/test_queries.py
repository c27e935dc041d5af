"""Registered queries against their SQL text, or a brute-force version where SQL has none."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from compare import differences, oracle_connection
from proxysift.llm import span_dedup, toxicity
from proxysift.llm.oracles import ORACLES
from proxysift.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text or "" for row in rows}


def test_every_operator_has_a_query():
    numbers = sorted(int(name.split("_")[0].removeprefix("op")) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, connection, name):
    assert differences(QUERIES[name](spark, SF), connection, ORACLES[name]) == ""


def _likeness(a: str, b: str) -> float:
    left, right = (Counter(x.encode().lower().split()) for x in (a, b))
    return sum((left & right).values()) / max(1, sum((left | right).values()))


def test_fingerprints(spark, documents):
    rows = {row.doc_id: row for row in QUERIES["op1_fingerprints"](spark, SF).collect()}
    order = sorted(documents, reverse=True)
    errors = []
    prints = defaultdict(set)
    for doc, following in zip(order, order[1:] + order[:1], strict=True):
        text, other, row = documents[doc], documents[following], rows[doc]
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [row.near_edited - _likeness(text, edited), row.near_next - _likeness(text, other)]
        prints[text].add(row.fingerprint)
    assert all(len(found) == 1 for found in prints.values())
    assert abs(sum(errors)) / len(errors) < 0.03
    assert math.sqrt(sum(e * e for e in errors) / len(errors)) < 0.09


def test_substring_dedup(spark, documents):
    rows = {row.doc_id: row for row in QUERIES["op2_substring_dedup"](spark, SF).collect()}
    seen, gone = set(), defaultdict(set)
    for doc in sorted(documents):
        for run, start, stop in span_dedup.sentence_runs(documents[doc]):
            if run in seen:
                gone[doc].update(range(start, stop))
            seen.add(run)
    assert any(gone.values())
    for doc, text in documents.items():
        bounds = span_dedup.sentence_bounds(text)
        kept = "".join(text[a:b] for i, (a, b) in enumerate(bounds) if i not in gone[doc])
        assert rows[doc].text == (kept.rstrip() if gone[doc] else text)
        assert (rows[doc].n_removed, rows[doc].n_sentences) == (len(gone[doc]), len(bounds))


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {row.doc_id: row.toxic for row in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity"](spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.5) for row in rows)
    judged = [(row.predicted, labels[row.doc_id]) for row in rows if row.held_out and row.doc_id in labels]
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    assert sum(a == b for a, b in judged) / len(judged) > 0.93
    assert not any(a > b for a, b in judged)


def test_ngram_jaccard(spark, documents):
    rows = {row.doc_id: row for row in QUERIES["op6_ngram_jaccard"](spark, SF).collect()}
    sets = {}
    for doc, text in documents.items():
        words = text.encode().lower().split()
        sets[doc] = {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()
    root = {doc: doc for doc in sets}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {doc: (len(sets[doc]), find(doc)) for doc in sets} == {
        doc: (row.n_shingles, row.component_id) for doc, row in rows.items()
    }


def test_lm_scores(spark, documents):
    rows = {row.doc_id: row for row in QUERIES["op9_lm_scoring"](spark, SF).collect()}
    held = {doc: zlib.crc32(str(doc).encode()) % 7 == 2 for doc in documents}
    counts = Counter()
    for doc, text in documents.items():
        if not held[doc]:
            counts.update([*text.encode().lower().split(), "end"])
    total, types = sum(counts.values()), len(counts)
    for doc, text in documents.items():
        words = [*text.encode().lower().split(), "end"]
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in words)
        row = rows[doc]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held[doc], len(words), total)
        assert row.n_known == sum(counts[w] > 0 for w in words)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score < 0 and row.bits_per_byte < 8


def test_toxicity_model_ignores_ids():
    rows = [("you are a stupid idiot", 1), ("what an idiot you are", 1), ("good day to you", 0), ("a fine day", 0)]
    assert toxicity.fit(rows).weights == toxicity.fit(reversed(rows)).weights
