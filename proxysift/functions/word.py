"""The behaviour word: eight discrete features of a record joined by ``_``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from proxysift import constants as C
from proxysift.functions.bins import entropy_bin, log_bin
from proxysift.functions.entropy import string_entropy


def hour_of(time: Column, separator: str = ":") -> Column:
    """The integer in front of the first separator, NULL when there is none."""
    head = F.substring_index(time, separator, 1)
    sign = F.translate(head, "0123456789", "")
    return F.when(sign.isin("", "+", "-"), head.try_cast("int"))


def content_group(content_type: Column) -> Column:
    """``image`` of ``image/png``; a value of slashes only is an unknown type."""
    only_slashes = (content_type != "") & (F.ltrim(content_type, F.lit("/")) == "")
    return F.when(only_slashes, C.UNKNOWN_CONTENT_TYPE).otherwise(
        F.substring_index(content_type, "/", 1)
    )


def response_code(code: Column) -> Column:
    return F.coalesce(code, F.lit(C.UNKNOWN_RESPONSE_CODE))


def behaviour_word(
    popularity: Column,
    host: Column,
    time: Column,
    method: Column,
    uri: Column,
    content_type: Column,
    agent_count: Column,
    code: Column,
) -> Column:
    """The word of one record, ``word_error`` when a needed feature is missing."""
    hour = hour_of(time)
    complete = (
        host.isNotNull()
        & hour.isNotNull()
        & uri.isNotNull()
        & content_type.isNotNull()
        & agent_count.isNotNull()
    )
    features = F.concat_ws(
        "_",
        popularity.cast("string"),
        hour.cast("string"),
        F.coalesce(method, F.lit(C.NO_METHOD)),
        entropy_bin(string_entropy(uri)).cast("string"),
        content_group(content_type),
        log_bin(agent_count).cast("string"),
        log_bin(F.length(uri)).cast("string"),
        response_code(code),
    )
    return F.when(complete, features).otherwise(C.WORD_ERROR)
