"""Evaluate a costly expression once, however often its result is used."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Spark would copy a costly expression into every branch that names it; a one-element
    ``transform`` binds it to a lambda variable instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Append a column that later filters read instead of computing it a second time.

    The optimizer moves a filter below a projection by copying the projected expression
    into the filter. It does not move one below a generator, so a one-element ``explode``
    of the projected value keeps it computed once.
    """
    held = f"_{name}_held"
    return df.withColumn(held, value).select(
        *df.columns, F.explode(F.array(held)).alias(name)
    )
