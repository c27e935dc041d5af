"""From analysis input to cleaned records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxysift import constants as C
from proxysift import schemas


def split_timestamp(df: DataFrame) -> DataFrame:
    """``p_date`` and ``p_time`` around the first ``T`` of ``timestamp``."""
    stamp = F.col("timestamp")
    time = F.when(F.contains(stamp, F.lit("T")), F.split_part(stamp, F.lit("T"), F.lit(2)))
    return df.withColumns({"p_date": F.substring_index(stamp, "T", 1), "p_time": time})


def compose_uri(df: DataFrame) -> DataFrame:
    """``fulluri`` from host, path and query; a record without a path has none."""
    return df.withColumn(
        "fulluri",
        F.concat(
            F.coalesce("csHost", F.lit("")), "csUriPath", F.coalesce("csUriQuery", F.lit(""))
        ),
    ).drop("csUriPath", "csUriQuery", "csUriExtension")


def rename_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(schemas.CLEAN_NAMES)


def _present(df: DataFrame, *names: str) -> DataFrame:
    """Rows in which every named column has a value, as conditions a scan can take over."""
    return df.where(reduce(lambda left, right: left & right, [F.col(n).isNotNull() for n in names]))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep records that have a date, a time, a client, a host and a URI."""
    return _present(df, "p_date", "p_time", "clientip", "host", "fulluri")


def fill_missing(df: DataFrame) -> DataFrame:
    return df.fillna(C.NO_VALUE, subset=["useragent", "resconttype"])


def clean_records(df: DataFrame) -> DataFrame:
    """The cleaned records of an analysis input table.

    The source columns behind the not-null rules are filtered by name as well, so that the
    conditions reach the Parquet scan.
    """
    return (
        _present(df, "timestamp", "cIp", "csHost", "csUriPath")
        .transform(split_timestamp)
        .transform(compose_uri)
        .transform(rename_columns)
        .transform(drop_incomplete)
        .transform(fill_missing)
        .select(*schemas.CLEAN_COLUMNS)
    )
