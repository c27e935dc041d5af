"""Conversation repair against trying every edit, and odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pandas as pd
import pytest

from proxysift.llm import turn_repair as tr

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
EMPTY = hashlib.sha256().hexdigest()


def cheapest(messages):
    """Least cost and, of its edits, the least letters, by trying all; with the repaired lines."""
    best = None
    for edits in itertools.product("DKR", repeat=len(messages)):
        if any(edit != "D" and fault in ("blank", "duplicate") for edit, (_, _, fault) in zip(edits, messages, strict=True)):
            continue
        for gaps in itertools.product(range(3), repeat=len(messages) + 1):
            letters, roles, lines, cost = "", "", [], 0
            first_kept = True
            for k in range(len(messages) + 1):
                for edit, message in [("I", None)] * gaps[k] + ([(edits[k], messages[k])] if k < len(messages) else []):
                    letters += edit
                    cost += {"D": 3, "K": 0, "R": 2, "I": 2}[edit]
                    if edit == "D":
                        continue
                    role, text, fault = message or (None, "", None)
                    cost += fault == "truncated"
                    if edit != "K":
                        role = "assistant" if roles.endswith("u") else "user"
                    roles += role[:1]
                    lines.append(f"{role}:{text}")
                    first_kept = False
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, letters) < best[:2]):
                best = (cost, letters, lines)
    return best


def found(messages):
    """The same by the operator's two functions, one message per batch."""
    rows = [("=1", role, text, "0", fault, role[:1]) for role, text, fault in messages]
    frames = [pd.DataFrame([row], columns=["conv", "role", "text", "turn", "fault", "letter"]) for row in reversed(rows)]
    marked = list(tr._backward(iter(frames)))[::-1]
    (report,) = tr._report(iter(marked))
    lines = [f"{r.role}:{r.text}" for frame in tr._messages(iter(marked)) for r in frame.itertuples()]
    row = report.iloc[0]
    assert row.repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return row.cost, row.audit, lines


def test_edits_are_the_cheapest_and_first_ones():
    kinds = [("system", "a."), ("user", "b."), ("assistant", "c."), ("tool", "d.")]
    faults = [None, None, None, "truncated", "blank", "duplicate"]
    chance = random.Random(7)
    for _ in range(60):
        messages = [(*chance.choice(kinds), chance.choice(faults)) for _ in range(chance.randint(1, 4))]
        assert found(messages) == cheapest(messages), messages


def expected(rows):
    """A conversation's report, read as the contract says it."""
    order = sorted(
        ((turn is not None, turn or 0, role if role is not None else " ", text if text is not None else " ", turn) for turn, role, text in rows),
        key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()),
    )
    seen, messages = set(), []
    for *_, role, text, _turn in order:
        words = text.strip(tr.SPACES)
        fault = None
        if not words:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif words[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        messages.append((role, text, fault))
    turns = [r[4] for r in order if r[4] is not None]
    letters = [role[:1] for role, _, _ in messages]
    cost, audit, lines = cheapest(messages)
    counts = [sum(fault == name for *_, fault in messages) for name in ("blank", "duplicate", "truncated")]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts,
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(letters)),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


ODD = {
    1: [(0, "system", "s."), (1, "user", "u?"), (4, "assistant", "a!")],
    2: [(None, None, None), (2, "user", "x."), (2, "user", "x."), (2, "assistant", "Z")],
    3: [(1, "assistant", "x. \x0b"), (1, "assistant", "x. \x0b"), (1, "Xy", "\x1c")],
    4: [(None, "user", ""), (None, "user", "null turn.")],
    None: [(5, "user", "null id."), (-5, "assistant", "İ. "), (0, "tool", "t")],
}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(conv, *row) for conv, rows in ODD.items() for row in rows], SCHEMA)


def test_odd_rows(odd):
    from pyspark.sql import functions as F

    clashing = odd.withColumns({name: F.lit("own") for name in ("conv", "nth", "fault", "letter", "packed", "copy", "_conv")})
    rows = {row.conv_id: tuple(row)[1:] for row in tr.repair_report(clashing).collect()}
    assert rows == {conv: expected(messages) for conv, messages in ODD.items()}
    messages = tr.repaired_messages(odd).where("conv_id = 1").orderBy("place").collect()
    assert [(m.role, m.text, m.edit) for m in messages] == [("system", "s.", "K"), ("user", "u?", "K"), ("assistant", "a!", "K")]
    assert tr.repair_report(odd.limit(0)).collect() == [] and tr.repaired_after_damage(odd.limit(0)).collect() == []


def test_damage(spark, odd):
    rows = [(conv, turn, "assistant", f"t{conv}. {turn}!") for conv in range(6) for turn in range(40)]
    table = spark.createDataFrame([*rows, (77, None, None, None)], SCHEMA)
    want = []
    for conv, turn, role, text in [*rows, (77, None, " ", " ")]:
        fault = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        want += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    assert sorted(map(tuple, tr.damaged(table).collect()), key=str) == sorted(want, key=str)
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = tr.repaired_after_damage(spark.createDataFrame([(lost, 0, "user", "x.")], SCHEMA)).collect()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", EMPTY)


def test_one_conversation_over_many_batches(spark):
    """Turns arrive in no order, in batches much smaller than the conversation."""
    n = 6000
    rows = [(1, (i * 7919) % n, "user" if (i * 7919) % n % 2 == 0 else "assistant", f"m{(i * 7919) % n}.") for i in range(n)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        (row,) = tr.repair_report(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    text = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:m{i}." for i in range(n))
    assert (row.cost, row.gaps, row.illegal, row.audit) == (0, 0, 0, "K" * n)
    assert row.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_rows_are_dealt_once(odd):
    text = tr.repair_report(odd)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("MapInPandas") == 2
