"""Batch job: raw log lines to a date-partitioned table and a reject table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from proxysift import constants as C
from proxysift.operators import cast_columns, parse_lines, record_table, rejected
from proxysift.params import JobParams
from proxysift.session import durable, released
from proxysift.sources import publish, read_lines, removed, write_table


@dataclass(frozen=True)
class JobResult:
    """Line counts of one run."""

    valid: int
    invalid: int


def proxy_table(parsed: DataFrame, params: JobParams) -> DataFrame:
    """Typed, partitionable records of the accepted lines."""
    return cast_columns(record_table(parsed, params.parser, params.zone)).drop("time")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("value string").text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def run_proxy_job(spark: SparkSession, params: JobParams) -> JobResult:
    """Read, parse and write both outputs.

    Lines are parsed once, into a table in the shared folder from which both outputs are cut,
    and counted in the same pass. Both outputs are written beside their targets first and
    moved there when both are complete: a failure while either is written leaves both targets
    as they were. An output without rows is not written, but with ``overwrite`` one that an
    earlier run has left is replaced by an empty table. With ``error`` nothing is written if
    either target exists.
    """
    targets = {path: _exists(spark, path) for path in (params.out_path, params.invalid_path)}
    if params.save_mode == "error" and any(targets.values()):
        raise FileExistsError(f"an output already exists at {[path for path, there in targets.items() if there]}")
    staging = f"{params.out_path.rstrip('/')}-staged-{uuid4().hex}"
    clear = params.save_mode == "overwrite"
    staged = {}
    with released(spark):
        seen = Observation()
        is_valid = F.col("error").isNull()
        lines = parse_lines(read_lines(spark, params.in_path, params.in_options), params.parser)
        parsed = durable(lines.observe(seen, F.count_if(is_valid).alias("valid"), F.count_if(~is_valid).alias("invalid")))
        result = JobResult(**seen.get)
        try:
            if result.valid or (clear and targets[params.out_path]):
                staged[f"{staging}/table"] = params.out_path
                write_table(
                    proxy_table(parsed, params), f"{staging}/table", params.out_format, "error",
                    [C.PARTITION_COLUMN] if result.valid else [], params.out_options,
                )
            if result.invalid or (clear and targets[params.invalid_path]):
                staged[f"{staging}/rejects"] = params.invalid_path
                write_table(rejected(parsed), f"{staging}/rejects", params.out_format, "error", options=params.out_options)
            publish(spark, staged, params.save_mode)
        finally:
            removed(spark, staging)
    return result


# Jobs by parser name.
JOBS: dict[str, Callable[[SparkSession, JobParams], JobResult]] = {"Proxy": run_proxy_job}


def run_job(spark: SparkSession, params: JobParams) -> JobResult:
    if params.parser not in JOBS:
        raise ValueError(f"no job for parser {params.parser!r}, use one of {sorted(JOBS)}")
    return JOBS[params.parser](spark, params)
