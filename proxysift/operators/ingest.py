"""From raw lines to the typed record table and the reject table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from proxysift import constants as C
from proxysift import schemas
from proxysift.functions import (
    convert_field,
    epoch_seconds,
    event_date,
    has_text,
    head_split,
    iso_text,
    parse_time,
    record_fields,
    repair_csv,
    split_quoted,
)
from proxysift.functions.binding import with_bound


def timestamp_index(parser: str) -> int:
    """Position of the timestamp among the record fields of a log source."""
    return C.TIMESTAMP_INDEX.get(parser, C.DEFAULT_TIMESTAMP_INDEX)


def parse_lines(lines: DataFrame, parser: str = "Proxy", delimiter: str = " ") -> DataFrame:
    """One row per non-blank line: ``raw, fields, moment, error, stage``.

    ``fields`` are the line's fields and ``moment`` its timestamp. No bad line fails the
    job: what went wrong stands in ``error``, where in ``stage``.
    """
    split = with_bound(
        lines.where(has_text(F.col("value"))).withColumnRenamed("value", "raw"),
        "fields",
        head_split(split_quoted(F.col("raw"), delimiter)),
    )
    fields = F.col("fields")
    stamp = record_fields(fields)[timestamp_index(parser)]
    timed = with_bound(
        split, "moment", F.when(F.size(fields) == C.FIELD_COUNT, parse_time(stamp))
    )
    error = (
        F.when(fields.isNull(), C.ERROR_QUOTES)
        .when(F.size(fields) != C.FIELD_COUNT, C.ERROR_COLUMNS)
        .when(F.col("moment").isNull(), C.ERROR_TIME)
    )
    stage = F.when(F.col("error") == C.ERROR_TIME, C.STAGE_TIME).when(
        F.col("error").isNotNull(), C.STAGE_PARSER
    )
    return timed.withColumn("error", error).withColumn("stage", stage)


def rejected(parsed: DataFrame) -> DataFrame:
    """The lines that failed, with the reason."""
    return parsed.where(F.col("error").isNotNull()).select(*schemas.REJECTS.names)


def accepted(parsed: DataFrame) -> DataFrame:
    """The lines that did not fail."""
    return parsed.where(F.col("error").isNull()).drop("error", "stage")


def with_converted_time(
    parsed: DataFrame, parser: str = "Proxy", zone: str = "EST", keep_original: bool = True
) -> DataFrame:
    """Append the zone-converted time and its epoch second, after the original text or not."""
    stamp = record_fields(F.col("fields"))[timestamp_index(parser)]
    columns = {
        "orig_timestamp": stamp,
        "iso_timestamp": iso_text(F.col("moment"), zone),
        "epoch_timestamp": epoch_seconds(F.col("moment")),
    }
    if not keep_original:
        del columns["orig_timestamp"]
    return parsed.withColumns(columns)


def record_table(parsed: DataFrame, parser: str = "Proxy", zone: str = "EST") -> DataFrame:
    """Accepted lines bound to the record schema by position, plus ``event_date``."""
    timed = with_converted_time(accepted(parsed), parser, zone)
    named = zip(record_fields(F.col("fields")), schemas.PROXY_FIELDS, strict=True)
    return timed.select(
        *[value.alias(name) for value, name in named],
        *schemas.TIME_FIELDS,
        event_date(F.col("orig_timestamp")).alias(C.PARTITION_COLUMN),
    )


def cast_columns(df: DataFrame) -> DataFrame:
    """Numeric columns to their types; text that is no number becomes NULL."""
    return df.withColumns(
        {name: F.col(name).try_cast(kind) for name, kind in schemas.CASTS.items()}
    )


def adapt_for_analysis(table: DataFrame) -> DataFrame:
    """Columns of the ingested table under the names the analysis reads, all as text.

    A log's placeholder for "no value" becomes NULL, so that no address ends in it and
    cleaning can drop what is incomplete.
    """
    names = schemas.ANALYSIS_COLUMNS.items()
    return table.select(*[convert_field(F.col(old).cast("string")).alias(new) for old, new in names])


def parse_csv(lines: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Repaired CSV lines as ``(rows, rejects)``.

    A line is rejected when a quoted field does not end or when it does not have one value
    per column.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*columns, "_bad"]])
    repaired = lines.select(repair_csv(F.col("value")).alias("line"))
    plain = F.regexp_replace("line", r'\\["\\]', "")
    unfinished = F.length(F.regexp_replace(plain, '[^"]', "")) % 2 == 1
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = with_bound(
        repaired, "row", F.from_csv("line", F.lit(schema.simpleString()[7:-1].replace(":", " ")), options)
    )
    bad = F.col("row._bad").isNotNull() | unfinished
    rows = parsed.where(~bad).select(
        *[F.coalesce(F.col(f"row.`{name}`"), F.lit("")).alias(name) for name in columns]
    )
    return rows, parsed.where(bad).select("line")
