"""Personal data: the plain rules, and the pattern graph against the same rounds in plain Python."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from proxysift.llm import private_data as pd_
from proxysift.llm.queries import QUERIES

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD = "4130383451285691"


def by_rule(text):
    found = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            check = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
            if (
                kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")))
                or (kind == "card" and 16 <= len(digits) <= 19 and check % 10 == 0) or (kind == "phone" and 8 <= len(digits) <= 15)
            ):
                found.append((kind, *m.span()))
    return found


@pytest.mark.parametrize("text", [
    "", "a@b.c", "a@b.c@d.e", " @b.c@d.e", "x@@y.z", "a.b+c%d-e_f@g-h.i.j.", "a@b", "a@.b", "é@b.c", "aé@b.c", "a@b.c.d@e.f", "@", "a@b..c@d.e",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255", "01.002.3.4444", "1.2.3", "1.2.3.4.", "0000.0.0.0",
    CARD, f"{CARD[:4]} {CARD[4:8]}-{CARD[8:12]} {CARD[12:]}", f"5 {CARD}", f"{CARD} 1", "4130383451285692", f"+1 (269) 555-3296 {CARD}",
    "+1 (386) 555-3733", "+1", "+12", "+123", "+1 2345678", "+1 (2) 3", "+1 555 123 4567 +2 555 123 4567", "++1 555 123 4567", "+1...2345678)",
    "+1 (314) 555-6532 71.187.144.186", "７ ٣ +٣ 555 1234567", f"{CARD}\n{CARD}",
])
def test_base_spans_follow_the_rules(text):
    assert pd_.base_spans(text) == by_rule(text)


def test_long_runs_take_linear_time():
    for piece in ("a", "1", "1.", "+1", "@", "a@", "1 ", ".", "+1 ("):
        text = piece * (400_000 // len(piece))
        assert all(0 <= s < e <= len(text) for _, s, e in pd_.base_spans(text))


def test_checks_of_a_kind():
    assert pd_.valid("phone", "+1 (386) 555-3733") and not pd_.valid("phone", "12345") and not pd_.valid("phone", "12345678x")
    assert pd_.valid("ip", "1.2.3.255") and not pd_.valid("ip", "1.2.3.256") and not pd_.valid("ip", "1.2.3")
    assert pd_.valid("email", "a@host") and not pd_.valid("email", "@a") and not pd_.valid("card", CARD[:-1])


def texts():
    """Cards and telephone numbers, each alone, and rows where one hides the other from its rule."""
    def card(n):
        for check in range(10):
            if pd_.luhn(digits := f"4{n * 7919:014d}{check}"):
                return digits
    rows = [f"words around {card(n)} and more words" for n in range(1, 31)]
    rows += [f"call me +1 ({200 + n}) 555-{1000 + n} or not" for n in range(30)]
    hidden = f"ring +1 (777) 555-7777 {card(99)} today."
    mail = [f"write to mailto n{n}@host{n}.example.com today" for n in range(30)]
    return [*rows, *mail, hidden, hidden, "write to mailto root@localhost today", "see 12 of 3456 and 99", "version 4.0. 123456789", None, ""]


def brute(rows):
    """Spans added by the same rounds, on dictionaries."""
    spans, edges, seeds, possible = [], defaultdict(set), defaultdict(int), {}
    for row, text in enumerate(rows):
        text = text or ""
        base = by_rule(text)
        listed = [(1 << pd_.KINDS.index(kind), s, e) for kind, s, e in base]
        listed += [(0, s, e) for s, e in pd_.candidates(text, base)]
        for seed, s, e in listed:
            value = text[s:e]
            spans.append((row, s, e, value, seed, pd_.patterns(text, s, e)))
            seeds[value] |= seed
            possible[value] = [pd_.valid(kind, value) for kind in pd_.KINDS]
            for pattern in pd_.patterns(text, s, e):
                edges[pattern].add(value)
    score = {v: [float(bool(seeds[v] >> k & 1)) for k in range(4)] for v in seeds}
    for _ in range(pd_.ROUNDS):
        confidence = {p: [sum(score[v][k] for v in vs) / (len(vs) + 1) for k in range(4)] for p, vs in edges.items()}
        new = {v: list(s) for v, s in score.items()}
        for v in seeds:
            if not seeds[v]:
                best = [max(confidence[p][k] for p, vs in edges.items() if v in vs) for k in range(4)]
                new[v] = [b if b >= pd_.CONFIDENT and possible[v][k] else 0.0 for k, b in enumerate(best)]
        score = new
    results = []
    for row, text in enumerate(rows):
        offers = []
        for of, s, e, value, seed, found in spans:
            options = [
                (confidence[p][k], -k) for p in found for k in range(4) if confidence[p][k] >= pd_.CONFIDENT and possible[value][k]
            ]
            if of == row and not seed and options:
                best = max(options)
                offers.append((-best[0], s - e, s, -best[1], e))
        kept = []
        for _, _, s, kind, e in sorted(offers):
            if all(e <= a or b <= s for _, a, b in kept):
                kept.append((pd_.KINDS[kind], s, e))
        results.append(pd_.joined(by_rule(text or "") + kept))
    return results


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, text) for i, text in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    clashing = docs.withColumns({name: F.lit("own") for name in ("rid", "base", "value", "seed", "pattern", "score")})
    return {row.doc_id: row for row in pd_.private_spans(clashing).collect()}


def test_spans_equal_plain_rounds(found):
    want = brute(texts())
    assert {doc: row.spans for doc, row in found.items()} == dict(enumerate(want))
    for doc, text in enumerate(texts()):
        base = by_rule(text or "")
        row = found[doc]
        assert row.base_sha256 == hashlib.sha256(pd_.joined(base).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pd_.KINDS]


def test_hidden_numbers_are_found(found):
    hidden = next(i for i, text in enumerate(texts()) if text and "777" in text)
    assert found[hidden].spans == "card:23:39,phone:5:22" and found[hidden].n_card == 0
    assert found[hidden].spans == found[hidden + 1].spans
    assert found[hidden + 2].spans == "email:16:30"  # by the words before it
    assert found[hidden + 3].spans == found[hidden + 4].spans == ""


def test_edges(spark):
    schema = "doc_id string, text string"
    rows = [("x", "a@b.c"), ("x", "a@b.c"), (None, "1.2.3.4"), ("y", None), ("z", " "), ("w", "9 " * 50_000)]
    result = pd_.private_spans(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or "", r.spans) for r in result) == sorted(
        [("x", "email:0:5")] * 2 + [("", "ip:0:7"), ("y", ""), ("z", ""), ("w", "")]
    )
    assert pd_.private_spans(spark.createDataFrame([], schema)).collect() == []


def test_query_keeps_the_base(spark):
    sf = "/root/testdata/sf0.001"
    texts_ = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op13_private_data"](spark, sf).collect()}
    want = brute(list(texts_.values()))
    assert {doc: rows[doc].spans for doc in texts_} == dict(zip(texts_, want, strict=True))
