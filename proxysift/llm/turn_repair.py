"""Repair of a conversation's structure: the cheapest edits that give turns in order.

The roles of a whole conversation, by their first letters, are to be empty or one system
message at most and then user and assistant in turn, ``(s?(ua)+)?``. A message is kept (K,
free), given the role user or assistant (R, 2) or deleted (D, 3; blank and repeated ones always
are), and an empty message of either role may be inserted anywhere (I, 2). A truncated message
that stays costs 1 more. Of the cheapest edits those whose letters come first count.

Rows are dealt once, by conversation, and Spark sorts them three times inside their partition:
to find repeated messages, by falling turn and by rising turn. Over falling turns a Python
function carries the least cost from each of the four states to the end, four numbers, from
batch to batch. What it would have to keep for the way back is one byte per message (the best
edit for each state, two bits), and it is handed to Spark as a column, so that the next sort
holds it and spills it; over rising turns a second function reads it and carries only
the state. No conversation is ever held whole in a task, however long it is. One
conversation is read by one task, since each of its edits depends on all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# The state after a user or assistant message: what the sequence needs next.
NEXT = (USER, USER, ASSISTANT, USER)
# The least cost from each state to the end of a conversation, by insertions alone.
AT_END = (0, 2 * INSERT, INSERT, 0)
# Two bits name an edit; the letters' order is the order of equally cheap edits.
LETTERS = "DIKR"
D, I, K, R = range(4)  # noqa: E741

ADJACENT = {"su", "ua", "au"}


def step(costs: tuple[int, ...], letter: str, must_go: bool, truncated: bool) -> tuple[tuple[int, ...], int]:
    """Costs to the end from before a message, from those after it, and the best edit of each state.

    The edits of the four states are packed in one number, two bits each, the first state lowest.
    """
    stays = TRUNCATED if truncated else 0
    options = []
    for state in range(4):
        found = {D: DELETE + costs[state]}
        if not must_go:
            found[R] = REROLE + stays + costs[NEXT[state]]
            if letter == "s" and state == START:
                found[K] = KEEP + stays + costs[SYSTEM]
            elif letter == "ua"[NEXT[state] == ASSISTANT]:
                found[K] = KEEP + stays + costs[NEXT[state]]
        options.append(found)
    used = [min(found.values()) for found in options]
    # An insertion leads from user to assistant and back; two in a row never pay between these.
    best = [0] * 4
    best[USER] = min(used[USER], INSERT + used[ASSISTANT])
    best[ASSISTANT] = min(used[ASSISTANT], INSERT + used[USER])
    best[START] = min(used[START], INSERT + best[USER])
    best[SYSTEM] = min(used[SYSTEM], INSERT + best[USER])
    packed = 0
    for state, found in enumerate(options):
        found[I] = INSERT + best[NEXT[state]]
        packed |= min(edit for edit, cost in found.items() if cost == best[state]) << 2 * state
    return tuple(best), packed


@dataclass
class Walk:
    """The way forward through one conversation: state, counts and the growing report."""

    state: int = START
    last_turn: int | None = None
    last_letter: str | None = None
    audit: list[str] = field(default_factory=list)
    gaps: int = 0
    illegal: int = 0
    cost: int = 0
    faults: dict[str, int] = field(default_factory=lambda: {"blank": 0, "duplicate": 0, "truncated": 0})

    def _insertions(self, packed: int | None) -> Iterator[tuple[str, str, str]]:
        while (self.state in (SYSTEM, USER)) if packed is None else (packed >> 2 * self.state & 3) == I:
            self.state = NEXT[self.state]
            self.cost += INSERT
            yield "I", ROLES[self.state], ""

    def read(self, role: str, text: str, turn: str | None, fault: str | None, packed: int) -> Iterator[tuple[str, str | None, str | None]]:
        """The edits that a message takes: insertions before it, then its own, as letter, role, text."""
        letter = role[:1]
        if self.last_letter is not None and self.last_letter + letter not in ADJACENT:
            self.illegal += 1
        self.last_letter = letter
        if turn is not None:
            number = int(turn)
            self.gaps += max(0, number - self.last_turn - 1) if self.last_turn is not None else 0
            self.last_turn = number
        if fault:
            self.faults[fault] += 1
        yield from self._insertions(packed)
        edit = packed >> 2 * self.state & 3
        if edit == D:
            self.cost += DELETE
            yield "D", None, None
            return
        self.cost += (TRUNCATED if fault == "truncated" else 0) + (REROLE if edit == R else KEEP)
        self.state = SYSTEM if edit == K and letter == "s" else NEXT[self.state]
        yield LETTERS[edit], ROLES[self.state] if edit == R else role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        """The insertions after the last message."""
        yield from self._insertions(None)


def _backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Append ``packed`` to messages by falling turn."""
    current, costs = "", AT_END
    for batch in batches:
        found = []
        for conv, letter, fault in zip(batch["conv"], batch["letter"], batch["fault"], strict=True):
            if conv != current:
                current, costs = conv, AT_END
            costs, packed = step(costs, letter, fault in ("blank", "duplicate"), fault == "truncated")
            found.append(packed)
        yield batch.assign(packed=pd.Series(found, index=batch.index, dtype="int64")).drop(columns="letter")


def _none(value):
    return None if value is None or value != value else value


def _walks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, Walk, Iterator, bool]]:
    """Conversation, its walk, edits of one message, and whether the conversation ends with them."""
    current, walk = None, Walk()
    for batch in batches:
        columns = [batch[name] for name in ("conv", "role", "text", "turn", "fault", "packed")]
        for conv, role, text, turn, fault, packed in zip(*columns, strict=True):
            if conv != current:
                if current is not None:
                    yield current, walk, walk.end(), True
                current, walk = conv, Walk()
            yield conv, walk, walk.read(role, text, _none(turn), _none(fault), packed), False
    if current is not None:
        yield current, walk, walk.end(), True


def _report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows, found, first = [], hashlib.sha256(), True
    for conv, walk, edits, last in _walks(batches):
        for letter, role, text in edits:
            walk.audit.append(letter)
            if letter != "D":
                found.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        if last:
            rows.append({
                "conv": conv, "gaps": walk.gaps, **walk.faults, "illegal": walk.illegal, "cost": walk.cost,
                "audit": "".join(walk.audit), "repaired_sha256": found.hexdigest(),
            })
            found, first = hashlib.sha256(), True
        if len(rows) == 1000:
            yield pd.DataFrame(rows)
            rows = []
    if rows:
        yield pd.DataFrame(rows)


def _messages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows, place = [], 0
    for conv, _, edits, last in _walks(batches):
        for letter, role, text in edits:
            if letter != "D":
                rows.append((conv, place, role, text, letter))
                place += 1
        place = 0 if last else place
        if len(rows) >= 1000:
            yield pd.DataFrame(rows, columns=["conv", "place", "role", "text", "edit"])
            rows = []
    if rows:
        yield pd.DataFrame(rows, columns=["conv", "place", "role", "text", "edit"])


def _faults(repeated: Column) -> Column:
    """The first of blank, duplicate, truncated that holds, else null."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    return (
        F.when(trimmed == "", "blank").when(repeated, "duplicate")
        .when(~F.right(trimmed, F.lit(1)).isin(list(ENDS)), "truncated")
    )


def _marked(messages: DataFrame) -> DataFrame:
    """Messages dealt by conversation, by rising turn in their partitions, each with its best edits.

    A conversation's name is its id as text behind a letter, so that null has one too.
    """
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))
    space = F.lit(" ")
    rows = messages.select(
        conv.alias("conv"), "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    ).repartition("conv")
    nth = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy("turn"))
    rows = rows.withColumn("nth", nth).withColumn("fault", _faults(F.col("nth") > 1))
    rows = rows.withColumn("letter", F.left("role", F.lit(1)))
    falling = rows.sortWithinPartitions("conv", *[F.col(name).desc() for name in ("turn", "role", "text", "nth")])
    kinds = {field.name: field.dataType.simpleString() for field in falling.schema}
    schema = ", ".join(f"{name} {kinds[name]}" for name in ("conv", "turn", "role", "text", "nth", "fault"))
    named = falling.select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", "nth", "fault", "letter")
    schema = schema.replace(f"turn {kinds['turn']}", "turn string")
    marked = named.mapInPandas(_backward, f"{schema}, packed long")
    number = F.col("turn").cast(kinds["turn"])
    return marked.sortWithinPartitions("conv", number, "role", "text", "nth").select(
        "conv", "turn", "role", "text", "fault", "packed"
    )


def _conv_id(messages: DataFrame) -> Column:
    return F.when(F.col("conv") != "null", F.substring("conv", 2, 1 << 30)).cast(messages.schema["conv_id"].dataType).alias("conv_id")


def repair_report(messages: DataFrame) -> DataFrame:
    """Per conversation ``gaps`` between turns, messages that are ``blank``, ``duplicate`` or
    ``truncated`` (the first that applies), ``illegal`` neighbours, and the repair's ``cost``,
    ``audit`` (a letter per edit) and hash (its ``role:text`` lines).

    Messages are ordered by turn, nulls first, then role and text. A null role or text is one
    space, so such a text is blank; an empty role is none of the three; a null conv_id is a
    conversation. Of equal messages all but
    the first are duplicates. Other columns are not read. The audit is one text per conversation.
    """
    schema = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    found = _marked(messages).mapInPandas(_report, schema)
    return found.select(_conv_id(messages), *found.columns[1:])


def repaired_messages(messages: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place, role, text, edit`` (K, R or I) per message."""
    found = _marked(messages).mapInPandas(_messages, "conv string, place long, role string, text string, edit string")
    return found.select(_conv_id(messages), *found.columns[1:])


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by a checksum of ``conv_id:turn``.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 takes the sentence ends out of it,
    3 repeats the row and 4 makes its role user. A null counts as one space.
    """
    space = F.lit(" ")
    key = F.concat(*[
        part for name in ("conv_id", "turn") for part in (F.coalesce(F.col(name).cast("string"), space), F.lit(":"))
    ][:-1])
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", space)
    changed = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ENDS, "")).otherwise(text)
    rows = conversations.withColumn("fault", fault).where("fault != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        changed.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def repaired_after_damage(conversations: DataFrame) -> DataFrame:
    """The report on damaged conversations, a row for every conv_id of the whole ones.

    One that has lost all its rows has zeros, no edits and the hash of an empty text.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    report = repair_report(damaged(rows))
    renamed = report.withColumnRenamed("conv_id", "_conv")
    ids = rows.select("conv_id").distinct()
    joined = ids.join(renamed, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return joined.select("conv_id", *[
        F.coalesce(name, F.lit(empty.get(name, 0))).alias(name) for name in report.columns[1:]
    ])
