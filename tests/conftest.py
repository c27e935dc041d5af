from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from proxysift import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", f"local[{os.environ.get("TEST_CPUS", "8")}]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
            "spark.checkpoint.dir": tmp_path_factory.mktemp("shared").as_uri(),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Values of a column expression over a list of inputs."""

    def run(inputs, data_type, make):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {data_type}")
        result = rows.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()
        return [row.y for row in result]

    return run
