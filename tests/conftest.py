from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """The values of one expression over a list of inputs, in order."""

    def run(function, inputs, dtype="string"):
        rows = [(i, v) for i, v in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"i int, v {dtype}").select("i", function("v").alias("out"))
        return [row.out for row in sorted(df.collect(), key=lambda row: row.i)]

    return run
