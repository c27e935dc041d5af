"""Equi-joins with a lookup table whose size is not known in advance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proxysift import constants as C

_ROW_OVERHEAD = 16
_FIXED = (T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _width(field: T.StructField) -> Column:
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, T.BinaryType):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, _FIXED):
        return F.when(column.isNotNull(), F.size(column) * 8).otherwise(0)
    if not isinstance(kind, _FIXED):
        raise TypeError(f"the size of {field.name}, a {kind.simpleString()}, cannot be measured")
    return F.lit(8)


def measured_bytes(table: DataFrame) -> int:
    """Size of a table's rows in memory, counted by one job over its columns."""
    width = sum((_width(field) for field in table.schema), F.lit(_ROW_OVERHEAD))
    return table.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def fits_broadcast(table: DataFrame, limit_bytes: int = C.BROADCAST_LIMIT_BYTES) -> bool:
    """Whether the measured table is small enough to be sent to every executor."""
    return measured_bytes(table) <= limit_bytes


def lookup_join(
    records: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    limit_bytes: int = C.BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Join ``records`` with a lookup table that has at most one row per key.

    A table measured below the limit is broadcast, so the records are not shuffled. A
    larger one is sort-merge joined on the key; adaptive execution then splits the
    partitions of hot keys by map output, which keeps the result whole and needs no salt.
    """
    small = fits_broadcast(table, limit_bytes)
    return records.join(F.broadcast(table) if small else table.hint("merge"), on, how)
