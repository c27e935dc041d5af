"""Discrete bins of numeric features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from proxysift import constants as C
from proxysift.functions.binding import let


def entropy_bin(value: Column, cuts: Sequence[float] = C.ENTROPY_CUTS) -> Column:
    """Index of the first cut that is not below the value, -1 when there is none."""

    def first_cut(v: Column) -> Column:
        chain = F.when(v.isNull(), F.lit(None))
        for index, cut in enumerate(cuts):
            chain = chain.when(v <= cut, index)
        return chain.otherwise(-1)

    return let(value.cast("double"), first_cut)


def log_bin(x: Column, base: int = 2) -> Column:
    """Logarithm to ``base`` cut to an integer; 0 where the logarithm does not exist."""
    d = x.cast("double")
    bins = (F.log10(d) / math.log10(base)).try_cast("int")
    return F.when((d <= 0) | F.isnan(d), 0).otherwise(bins)


def ceil_log2(x: Column) -> Column:
    """Ceiling of the binary logarithm; the smallest integer for 0."""
    d = x.cast("double")
    bins = F.ceil(F.log10(d) / math.log10(2)).try_cast("int")
    return (
        F.when(d == 0, F.lit(-2147483648)).when((d < 0) | F.isnan(d), 0).otherwise(bins)
    )
