"""Partitioned table writes and model persistence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.clustering import DistributedLDAModel, LDAModel, LocalLDAModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    table_format: str = "parquet",
    mode: str = "error",
    partitions: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Write ``df``, partitioned by the given columns.

    Rows are rebalanced by these columns first: the few rows that each task has for a value
    become one file instead of one per task, and a value with many rows is split over tasks.
    """
    if partitions:
        df = df.hint("rebalance", *[F.col(name) for name in partitions])
    writer = df.write.format(table_format).mode(mode).options(**(options or {}))
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)


def publish(spark: SparkSession, staged: Mapping[str, str], mode: str) -> None:
    """Move written tables, ``{staged path: target}``, to their targets, all of them at the end.

    With ``append`` the files join those of the target, whose names never clash; with
    ``overwrite`` a target is removed first, with ``ignore`` one that exists is left.
    """
    hadoop, Path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for source, target in staged.items():
        source, target = Path(source), Path(target)
        files = target.getFileSystem(hadoop)
        if files.exists(target):
            if mode == "ignore":
                continue
            if mode == "error":
                raise FileExistsError(str(target))
            if mode == "append":
                _join(files, Path, source, target)
                continue
            files.delete(target, True)
        files.mkdirs(target.getParent())
        if not files.rename(source, target):
            raise OSError(f"cannot move {source} to {target}")


def _join(files, Path, source, target) -> None:
    """Move the files below one folder to the same places below another."""
    files.mkdirs(target)
    for status in files.listStatus(source):
        name = status.getPath().getName()
        to = Path(target, name)
        if status.isDirectory():
            _join(files, Path, status.getPath(), to)
        elif not name.startswith("_") and not files.rename(status.getPath(), to):
            raise OSError(f"cannot move {status.getPath()} to {to}")


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def save_model(model: LDAModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> LDAModel:
    """A saved model; its metadata say which optimizer it was fitted with."""
    kind = DefaultParamsReader.loadMetadata(path, SparkSession.active())["class"]
    return (DistributedLDAModel if kind.endswith("DistributedLDAModel") else LocalLDAModel).load(path)
