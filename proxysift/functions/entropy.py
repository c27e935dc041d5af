"""Shannon entropy of the characters of a string."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from proxysift.functions.binding import let


def string_entropy(text: Column) -> Column:
    """Bits per character; 0 for the empty string.

    The characters are sorted and cut into runs of equal ones, so only one array element
    per distinct character reaches the summing step.
    """
    ordered = F.array_join(F.sort_array(F.split(text, "")), "")
    runs = F.regexp_extract_all(ordered, F.lit(r"(?s)(.)\1*+"), F.lit(0))

    def entropy(n: Column) -> Column:
        shares = F.transform(runs, lambda run: F.length(run) / n)
        return F.aggregate(
            shares, F.lit(0.0), lambda total, p: total - p * F.log10(p) / math.log10(2)
        )

    return F.when(text.isNotNull(), let(F.length(text).cast("double"), entropy))
