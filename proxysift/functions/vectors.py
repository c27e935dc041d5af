"""Array and vector columns."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VECTOR = T.StructType([T.StructField("v", VectorUDT())])


def widen(values: Column) -> Column:
    """Array of double from an array of any numeric type."""
    return values.cast("array<double>")


def dot(left: Column, right: Column, length: int) -> Column:
    """Sum of products of two arrays of a known length, as one compiled expression."""
    products = (F.get(left, F.lit(i)) * F.get(right, F.lit(i)) for i in range(length))
    return reduce(add, products)


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """ML vector from parallel arrays of ascending indices and of values.

    Spark has no built-in that makes a sparse vector from columns; its JSON reader does
    understand the vector type, so the row never leaves the JVM.
    """
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        indices.cast("array<int>").alias("indices"),
        values.cast("array<double>").alias("values"),
    )
    text = F.to_json(F.struct(parts.alias("v")))
    return F.from_json(text, _VECTOR, {"mode": "FAILFAST"})["v"]
