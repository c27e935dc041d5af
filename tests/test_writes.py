"""Files of partitioned writes, both outputs or none, and an order that is checked."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog import tables as t
from proxysift import JobParams
from proxysift import operators as op
from proxysift.plans import ingest_job, run_job
from proxysift.session import durable
from proxysift.sources import write_table

SF = "/root/testdata/sf0.001"


def test_few_files_per_date_from_many_tasks(spark, tmp_path):
    """64 tasks with rows of 20 dates each; one date has most of the rows."""
    rows = spark.range(0, 400_000, 1, 64).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.when(F.col("id") % 10 < 8, "2020-01-01").otherwise(F.concat(F.lit("2020-02-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0"))).alias("day"),
    )
    path = tmp_path / "out"
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "4m")
    try:
        write_table(rows, str(path), partitions=["day"])
    finally:
        spark.conf.unset(size)
    files = {day.name: len(list(day.glob("*.parquet"))) for day in path.glob("day=*")}
    assert files.pop("day=2020-01-01") > 1 and max(files.values()) <= 2
    assert spark.read.parquet(str(path)).agg(F.sum("id"), F.count("id")).first()[:] == (79999800000, 400_000)


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "raw")
    t.raw_lines(spark, SF).write.text(path)
    return path


@pytest.mark.parametrize("mode", ["error", "append", "overwrite"])
def test_a_fault_between_the_writes_leaves_neither(spark, lines, tmp_path, monkeypatch, mode):
    out = tmp_path / "out"
    params = JobParams("Proxy", in_path=lines, out_path=str(out), save_mode=mode)
    before = None
    if mode != "error":
        run_job(spark, params)
        before = sorted(p.name for p in out.rglob("*.parquet"))
    write = ingest_job.write_table
    calls = []

    def failing(*args, **kwargs):
        calls.append(args[1])
        if len(calls) == 2:
            raise OSError("planted")
        write(*args, **kwargs)

    monkeypatch.setattr(ingest_job, "write_table", failing)
    with pytest.raises(OSError, match="planted"):
        run_job(spark, params)
    found = sorted(p.name for p in out.rglob("*.parquet")) if out.exists() else None
    assert found == before and not list(tmp_path.glob("*staged*"))
    monkeypatch.setattr(ingest_job, "write_table", write)
    result = run_job(spark, params)
    times = 2 if mode == "append" else 1
    assert spark.read.parquet(str(out)).count() == times * result.valid
    assert spark.read.parquet(params.invalid_path).count() == times * result.invalid
    assert not list(tmp_path.glob("*staged*"))


def test_order_of_a_written_table(spark):
    rows = spark.range(0, 5000, 1, 8).select(((F.col("id") * 7919) % 5000 / 5000).alias("score"), F.lit("c").alias("clientip"))
    ordered = op.out_of_order(durable(op.least_likely_first(rows))).first()
    assert (ordered["within"], ordered["between"]) == (0, 0)
    unsorted = op.out_of_order(durable(rows)).first()
    assert unsorted["within"] > 0 and unsorted["between"] > 0
    each_alone = op.out_of_order(durable(rows.sortWithinPartitions("score"))).first()
    assert each_alone["within"] == 0 and each_alone["between"] > 0
    assert op.out_of_order(durable(rows.limit(0))).first()["within"] == 0
