"""Fill-in-middle: units, cuts, arrangements and the way back."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from proxysift.llm import fill_in_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [
    None, "", " ", "\n\t", "one", " one", "one ", "a b", "  a  b\x0b\x0c ", "ünï 日本 \U0001f600 x", "nbsp here too",
    "has <P> inside", "has <S>", "<M>", "< P > <", "a <", "x" * 70_000, "word " * 30_000, "tail <S", "q w e r t y u i o p" * 9,
]


def expected(doc_id, text, rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    hexed = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i % 17 else None, text) for i, text in enumerate(TEXTS * 6)]
    return spark.createDataFrame([*rows, *rows[:5]], "doc_id bigint, text string").withColumns(
        {name: F.lit("own") for name in ("draws", "form", "output", "n", "pieces")}
    )


@pytest.mark.parametrize("slice_bytes", [1, 1 << 24])
def test_examples_and_the_way_back(docs, monkeypatch, slice_bytes):
    monkeypatch.setattr(fim, "SLICE", slice_bytes)
    given = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    found = fim.restored(fim.arranged(docs)).collect()
    want = [(doc, *expected(doc, text), text or "") for doc, text in given]
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {"plain", "psm", "spm"} == {r.form for r in found}
    for row in found:
        assert row.output_sha256 == hashlib.sha256(row.output.encode()).hexdigest()
        assert row.restored_sha256 == hashlib.sha256(row.restored.encode()).hexdigest()
        own = sum(p.length for p in row.pieces if p.buffer == "text")
        assert own == len(row.restored.encode()) and all(p.start >= 0 and p.length >= 0 for p in row.pieces)


def test_shares_of_the_forms(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three four").alias("text"))
    counts = {row.form: row["count"] for row in fim.arranged(docs).groupBy("form").count().collect()}
    assert abs(counts["plain"] - 2000) < 150 and abs(counts["spm"] - 1600) < 150 and abs(counts["psm"] - 400) < 100
    assert fim.restored(fim.arranged(docs.limit(0))).collect() == []


def test_units_in_small_blocks(monkeypatch):
    chance = random.Random(3)
    for block in (1, 2, 7, 1 << 20):
        monkeypatch.setattr(fim, "BLOCK", block)
        for _ in range(60):
            text = "".join(chance.choice("ab é\n \t日") for _ in range(chance.randint(0, 40)))
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            units = UNIT.findall(text)
            assert fim.count_units(data) == len(units)
            for k in range(len(units) + 1):
                assert fim.unit_end(data, k, len(units)) == len("".join(units[:k]).encode())


def test_a_text_of_another_form_is_an_error():
    for data, form in ((b"no sentinel", "psm"), (b"<P>a<S>b", "psm"), (b"<P>a<S>b<M>c", "spm")):
        with pytest.raises(ValueError):
            fim.take_apart(data, form)
