"""Time parsing and zone conversion. Text output assumes the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from proxysift import constants as C

_DEFAULT_SHAPE = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}"
    r"([+-][0-9]{2}:?[0-9]{2}|Z)$"
)


def parse_time(text: Column, pattern: str = C.TIME_FORMAT) -> Column:
    """Timestamp of a text with an offset (``-0500``, ``-05:00`` or ``Z``), else NULL.

    The default layout is checked by shape and read by Spark's own cast, which costs no
    exception for a bad row; other layouts go through the pattern parser.
    """
    if pattern == C.TIME_FORMAT:
        return F.when(text.rlike(_DEFAULT_SHAPE), text.try_cast("timestamp"))
    with_colon = pattern.replace("Z", "XXX")
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(pattern)), F.try_to_timestamp(text, F.lit(with_colon))
    )


def iso_text(moment: Column, zone: str = "EST") -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSS±hh:mm`` in the target zone."""
    if zone not in C.ZONES:
        raise ValueError(f"unsupported zone {zone!r}, use one of {sorted(C.ZONES)}")
    local = F.from_utc_timestamp(moment, C.ZONES[zone])
    minutes = ((F.unix_seconds(local) - F.unix_seconds(moment)) / 60).cast("int")
    size = F.abs(minutes)
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSS"),
        F.when(minutes < 0, "-").otherwise("+"),
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )


def epoch_seconds(moment: Column) -> Column:
    return F.unix_seconds(moment)


def event_date(orig_timestamp: Column) -> Column:
    """``yyyyMMdd`` of the first ten characters, NULL when they are not a date."""
    return F.date_format(F.substring(orig_timestamp, 1, 10).try_cast("date"), "yyyyMMdd")
