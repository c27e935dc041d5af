"""Session settings and the shared-folder checkpoint every operator relies on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Settings that decide results or keep skewed joins balanced; all of them can be
# changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a partitioned write keep several files open instead of sorting each task.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}

SHUFFLE_PARTITION_BYTES = 64 * 1024 * 1024
LEAST_SHUFFLE_PARTITIONS = 200

# Paths of the tables that ``durable`` wrote, by application.
_made: dict[str, list[str]] = {}

STATIC_SETTINGS = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(
    app_name: str = "proxysift", master: str | None = None, input_bytes: int = 0, **extra: str
) -> SparkSession:
    """Create (or fetch) a session; the cluster's own sizing settings are left alone.

    Adaptive execution merges small shuffle partitions but starts from a fixed number of
    them. Name the size of the input to start from one per 64 MB of it.
    """
    settings = {**STATIC_SETTINGS, **RUNTIME_SETTINGS}
    if input_bytes:
        parts = max(input_bytes // SHUFFLE_PARTITION_BYTES, LEAST_SHUFFLE_PARTITIONS)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(parts)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    A local run without that setting gets a temporary folder; a cluster must name one that
    all executors share.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="proxysift-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table below the shared folder and return it read back.

    Used for derived tables (counts, dictionaries, the corpus) that feed several later jobs.
    It cuts the lineage: a lost executor costs a re-read of this table, not of the logs, and
    a later job reads only the columns it needs. ``released`` removes the tables again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid4().hex}"
    df.write.parquet(path)
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, the derived tables that were written inside it.

    For jobs that have written their result by then; a DataFrame that still reads such a
    table cannot be used afterwards.
    """
    made = _made.setdefault(spark.sparkContext.applicationId, [])
    before = len(made)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        while len(made) > before:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(made.pop())
            path.getFileSystem(hadoop).delete(path, True)
