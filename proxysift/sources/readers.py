"""Raw lines, proxy records and the ranked-domain list as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from proxysift import schemas


def read_lines(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """One row ``value`` per line of the text under ``path``."""
    return spark.read.options(**(options or {})).text(path).select("value")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The analysis input columns of a Parquet table; nothing else is read."""
    return spark.read.parquet(path).select(*schemas.ANALYSIS_INPUT.names)


def read_ranked_domains(spark: SparkSession, path: str) -> DataFrame:
    """Distinct first labels of the domains in a ``rank,domain`` list."""
    lines = spark.read.text(path)
    return ranked_labels(lines.select(F.split_part("value", F.lit(","), F.lit(2)).alias("domain")))


def ranked_labels(domains: DataFrame) -> DataFrame:
    """``domain_label``: the distinct first labels of a column ``domain``.

    Distinct, so that joining the list never multiplies records. An empty domain comes from
    a line without a comma and is ignored.
    """
    return (
        domains.where(F.col("domain") != "")
        .select(F.substring_index("domain", ".", 1).alias("domain_label"))
        .distinct()
    )
