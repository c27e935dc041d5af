"""Small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from proxysift import constants as C


def has_text(line: Column) -> Column:
    """True when the line holds any character above U+0020."""
    return line.rlike(r"[^\x00-\x20]")


def replace_all(text: Column, search: str, replacement: str) -> Column:
    """Replace every literal occurrence; NULL stays NULL."""
    return F.replace(text, F.lit(search), F.lit(replacement))


def convert_field(field: Column, data_type: str = "string") -> Column:
    """``-`` and the empty string mean "no value"; anything not convertible is NULL too."""
    return F.when(~field.isin(C.NO_VALUE, ""), field.try_cast(data_type))


def repair_csv(line: Column) -> Column:
    """Doubled double quotes become two single ones, backslash-escaped quotes plain ones."""
    return replace_all(replace_all(line, '""', "''"), '\\"', '"')
