"""Session settings and the shared folder."""

from pathlib import Path

from pyspark.sql import functions as F

from proxysift import build_session, configure
from proxysift.session import durable, released, shared_folder

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_folder_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == spark.sparkContext.getCheckpointDir()
    assert named is None or named.removeprefix("file://") in folder


def test_durable_table_is_read_from_files(spark):
    df = spark.range(100).select("id", F.array("id").alias("a"), F.lit(None).cast("string").alias("n"))
    table = durable(df)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, df.collect()))
    plan = table.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet [id" in plan and "Range" not in plan
    assert durable(df.limit(0)).count() == 0 and durable(df.limit(0)).dtypes == df.dtypes


def test_shuffle_width_follows_the_input(spark):
    try:
        build_session(input_bytes=10 * 2**40)
        assert spark.conf.get(INITIAL) == str(10 * 2**40 // (64 * 2**20))
        build_session(input_bytes=64 * 2**30)
        assert spark.conf.get(INITIAL) == "1024"
    finally:
        spark.conf.unset(INITIAL)


def test_released_tables_are_removed(spark):
    kept = durable(spark.range(3))
    with released(spark):
        inner = durable(spark.range(5))
        assert inner.count() == 5
        path = inner.inputFiles()[0]
    assert kept.count() == 3
    assert not Path(path.removeprefix("file://")).exists()
