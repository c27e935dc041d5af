"""Fill-in-middle examples: documents as piece tables over immutable buffers.

A piece is a descriptor (buffer, start, length) in bytes. The buffers never change: one is the
text as Arrow holds it, the other three are the sentinels. Cutting splits the one descriptor
of a document into prefix, middle and suffix; an arrangement permutes descriptors and puts
sentinels between them; restoring cuts an arranged text at its sentinels and applies the
inverse permutation. Hashes are fed descriptor by descriptor, and a text is only put together
where a caller asks for it.

A unit is a run of white space with the word after it, or white space at the end. Units are
counted in blocks of bytes, since their limits are ASCII: memory is the text and one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT, PREFIX, SUFFIX, MIDDLE = "text", "<P>", "<S>", "<M>"
SENTINELS = {name: name.encode() for name in (PREFIX, SUFFIX, MIDDLE)}
PLAIN, PSM, SPM = "plain", "psm", "spm"

# Which sentinel and which part of the cut text (0 prefix, 1 middle, 2 suffix) follow each other.
ARRANGEMENTS = {
    PSM: ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)),
    SPM: ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1)),
}

BLOCK = 1 << 20
# Bytes of text whose arranged forms are held at once; a longer text is held alone.
SLICE = 1 << 24

Piece = tuple[str, int, int]

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _word_ends(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per block its start and a mask of the bytes that end a word."""
    for start in range(0, data.size, BLOCK):
        space = _SPACE[data[start : start + BLOCK + 1]]
        inside, after = ~space[:BLOCK], space[1:]
        if after.size < inside.size:  # the last byte of the text
            after = np.append(after, True)
        yield start, inside & after


def count_units(data: np.ndarray) -> int:
    """Number of units of a text given as its UTF-8 bytes."""
    words = sum(int(np.count_nonzero(ends)) for _, ends in _word_ends(data))
    return words + bool(data.size and _SPACE[data[-1]])


def unit_end(data: np.ndarray, count: int, units: int) -> int:
    """Offset in bytes after the first ``count`` of the text's ``units`` units."""
    if count == 0 or count == units:
        return data.size if count else 0
    left = count
    for start, ends in _word_ends(data):
        here = int(np.count_nonzero(ends))
        if left <= here:
            return start + int(np.flatnonzero(ends)[left - 1]) + 1
        left -= here
    raise ValueError("more units asked for than the text has")


def cut(size: int, first: int, second: int) -> list[Piece]:
    """The descriptor of a whole text split in three at two offsets."""
    return [(TEXT, 0, first), (TEXT, first, second - first), (TEXT, second, size - second)]


def arrange(pieces: list[Piece], form: str) -> list[Piece]:
    """The three parts permuted, a sentinel before each."""
    order = ARRANGEMENTS[form]
    return [piece for name, part in order for piece in ((name, 0, len(SENTINELS[name])), pieces[part])]


def take_apart(data: bytes, form: str) -> list[Piece]:
    """Descriptors of the original text over the bytes of its arranged form."""
    if form == PLAIN:
        return [(TEXT, 0, len(data))]
    order, found, at = ARRANGEMENTS[form], {}, 0
    for k, (name, part) in enumerate(order):
        start = at + len(SENTINELS[name])
        if data[at:start] != SENTINELS[name]:
            raise ValueError(f"no {name} where form {form} has one")
        at = data.find(SENTINELS[order[k + 1][0]], start) if k + 1 < len(order) else len(data)
        if at < 0:
            raise ValueError(f"no {order[k + 1][0]} after {name}")
        found[part] = (TEXT, start, at - start)
    return [found[part] for part in range(len(order))]


def streamed(pieces: list[Piece], text: memoryview) -> Iterator[memoryview | bytes]:
    for name, start, length in pieces:
        yield text[start : start + length] if name == TEXT else SENTINELS[name]


def digest(pieces: list[Piece], text: memoryview) -> str:
    found = hashlib.sha256()
    for part in streamed(pieces, text):
        found.update(part)
    return found.hexdigest()


def _points(data: np.ndarray, piece: Piece) -> int:
    """Code points of a piece: bytes that do not continue a character."""
    _, start, length = piece
    part = data[start : start + length]
    return sum(int(np.count_nonzero((part[k : k + BLOCK] & 0xC0) != 0x80)) for k in range(0, length, BLOCK))


def _texts(column: pa.Array) -> Iterator[memoryview]:
    """Each value's bytes in the buffer that Arrow holds them in; null is empty."""
    _, offsets, values = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1] if offsets else [0] * (len(column) + 1)
    held = memoryview(values) if values is not None else memoryview(b"")
    for i in range(len(column)):
        yield held[at[i] : at[i + 1]] if column[i].is_valid else held[:0]


def _slices(batch: pa.RecordBatch, name: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``SLICE`` bytes of text each, or one row."""
    start = held = 0
    for i, text in enumerate(_texts(batch.column(name))):
        if i > start and held + len(text) > SLICE:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += len(text)
    yield batch.slice(start)


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


_PIECES = pa.list_(pa.struct([("buffer", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))
_ARRANGED = (
    "n long, form string, pieces array<struct<buffer:string,start:long,length:long>>, "
    "prefix_chars long, middle_chars long, output string, output_sha256 string"
)


def _shape(text: memoryview, numbers: list[int], rate: int, spm: int) -> tuple:
    """Units, form, pieces, code points of prefix and middle of one document."""
    data = np.frombuffer(text, dtype=np.uint8)
    units = count_units(data)
    whole = bytes(text)
    if not whole or any(mark in whole for mark in SENTINELS.values()) or numbers[2] % 100 >= rate:
        return units, PLAIN, [(TEXT, 0, data.size)], None, None
    ends = sorted((numbers[0] % (units + 1), numbers[1] % (units + 1)))
    parts = cut(data.size, *(unit_end(data, end, units) for end in ends))
    form = SPM if numbers[3] % 100 < spm else PSM
    return units, form, arrange(parts, form), _points(data, parts[0]), _points(data, parts[1])


def draws(doc_id: Column, seed: int) -> Column:
    """Four numbers of a document: the first digits of the hash of seed and id. A null id is empty."""
    text = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*[F.conv(F.substring(text, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)])


def arranged(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """Per row of ``docs`` its ``doc_id``, units ``n``, ``form``, descriptors ``pieces``, code points
    of prefix and middle (null if plain), the arranged text ``output`` and its hash.

    Of every 100 draws ``rate`` are arranged, of these ``spm`` suffix first. An empty or null
    text, and one that already holds a sentinel, stays plain. Equal rows give equal results;
    other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole, "text")):
            texts = list(_texts(batch.column("text")))
            numbers = batch.column("draws").to_pylist()
            found = [_shape(text, h, rate, spm) for text, h in zip(texts, numbers, strict=True)]
            units, forms, pieces, prefix, middle = zip(*found, strict=True) if found else ([],) * 5
            outputs = [b"".join(streamed(p, t)) for p, t in zip(pieces, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(units, pa.int64()), pa.array(forms, pa.string()),
                    pa.array([[{"buffer": b, "start": s, "length": n} for b, s, n in p] for p in pieces], _PIECES),
                    pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                    _strings(outputs),
                    pa.array([digest(p, t) for p, t in zip(pieces, texts, strict=True)], pa.string()),
                ],
                ["doc_id", "n", "form", "pieces", "prefix_chars", "middle_chars", "output", "output_sha256"],
            )

    rows = docs.select("doc_id", "text", draws(F.col("doc_id"), seed).alias("draws"))
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_ARRANGED}")


def restored(examples: DataFrame) -> DataFrame:
    """``examples`` (``form``, ``output`` and others) with the original ``restored`` text and its hash.

    Nothing but output and form is used. A text that its form does not describe is an error.
    """
    kept = [field for field in examples.schema if field.name not in ("restored", "restored_sha256")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole, "output")):
            outputs = list(_texts(batch.column("output")))
            tables = [
                take_apart(bytes(text), form or PLAIN)
                for text, form in zip(outputs, batch.column("form").to_pylist(), strict=True)
            ]
            texts = [b"".join(streamed(p, t)) for p, t in zip(tables, outputs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(field.name) for field in kept],
                    _strings(texts),
                    pa.array([digest(p, t) for p, t in zip(tables, outputs, strict=True)], pa.string()),
                ],
                [*[field.name for field in kept], "restored", "restored_sha256"],
            )

    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kept)
    return examples.select(*[F.col(f"`{field.name}`") for field in kept]).mapInArrow(
        run, f"{schema}, restored string, restored_sha256 string"
    )
