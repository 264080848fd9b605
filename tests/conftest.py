import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("marketlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def stored(spark, tmp_path):
    """Rows written to Parquet and read back: the optimizer folds literals and would hide runtime errors."""

    def store(rows, schema, name="rows"):
        path = str(tmp_path / name)
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    return store


@pytest.fixture
def plan_of():
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return plan
