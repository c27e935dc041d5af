"""Quote-aware split of a raw log line.

A line is cut at single delimiters and empty tokens are dropped. A token that has a double
quote at exactly one of its ends opens or closes a quoted field; everything from one such
edge to the next is one field, its tokens joined by one space. The edges' positions are
found first, so only a few array slices per line are needed instead of a fold that grows an
array token by token.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from proxysift import constants as C
from proxysift.functions.binding import let

_QUOTE = '"'


def split_quoted(line: Column, delimiter: str = " ") -> Column:
    """The fields of a line, quotes kept; NULL when the quoted fields do not pair up."""
    if len(delimiter) != 1:
        raise ValueError("the delimiter must be one character")
    pattern = delimiter if delimiter.isspace() else re.escape(delimiter)
    tokens = F.array_remove(F.split(line, pattern), "")
    return let(tokens, lambda found: let(_edges(found), lambda edges: _fields(found, edges)))


def _edges(tokens: Column) -> Column:
    """Positions of the edge tokens, between -1 and the number of tokens."""

    def position(token: Column, i: Column) -> Column:
        is_edge = token.startswith(_QUOTE) != token.endswith(_QUOTE)
        return F.when(is_edge, i)

    inner = F.array_compact(F.transform(tokens, position))
    return F.concat(F.array(F.lit(-1)), inner, F.array(F.size(tokens)))


def _fields(tokens: Column, edges: Column) -> Column:
    def between(first: Column, last: Column) -> Column:
        # Not slice(), which copies all tokens for every piece.
        picked = F.transform(F.sequence(first, last), lambda k: F.get(tokens, k))
        return F.when(first <= last, picked).otherwise(F.array().cast("array<string>"))

    def piece(i: Column) -> Column:
        start, end = F.get(edges, i), F.get(edges, i + 1)
        quoted = F.array(F.array_join(between(start, end), " "))
        return F.when(i % 2 == 0, between(start + 1, end - 1)).otherwise(quoted)

    pieces = F.transform(F.sequence(F.lit(0), F.size(edges) - 2), piece)
    return F.when(F.size(edges) % 2 == 0, F.flatten(pieces))


def head_split(fields: Column) -> Column:
    """Cut the first field at ``--``, dropping empty parts at its end."""

    def filled(parts: Column) -> Column:
        last = F.array_max(F.transform(parts, lambda part, i: F.when(part != "", i + 1).otherwise(0)))
        return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), last)).otherwise(parts)

    def cut(all_fields: Column) -> Column:
        head = let(F.split(F.get(all_fields, F.lit(0)), C.HEAD_SEPARATOR), filled)
        return F.concat(head, F.slice(all_fields, F.lit(2), F.size(all_fields)))

    return let(fields, cut)


def record_fields(fields: Column) -> list[Column]:
    """The 27 record values taken from the 31 line fields."""
    stamp = F.concat(F.get(fields, F.lit(3)), F.lit("T"), F.get(fields, F.lit(5)))
    rest = [F.get(fields, F.lit(i)) for i in range(6, C.FIELD_COUNT)]
    return [F.get(fields, F.lit(4)), stamp, *rest]
