import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tidemark.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
EVENT = "timepoint bigint, type string, published_at string, resource_uri string, data string"


@pytest.fixture(scope="session")
def make_log(spark):
    """Log from (timepoint, uri, type) triples; data names the timepoint."""

    def make(rows):
        full = [
            (tp, kind, f"2024-01-01T00:00:{tp % 60:02d}", uri,
             None if kind == "deleted" else f'{{"n":{tp}}}')
            for tp, uri, kind in rows
        ]
        return spark.createDataFrame(full, EVENT)

    return make


@pytest.fixture(scope="session")
def timepoints(spark):
    def make(values):
        return spark.createDataFrame([(v,) for v in values], "timepoint bigint")

    return make
