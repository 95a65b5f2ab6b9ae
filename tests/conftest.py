import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("terrace tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def ns(spark):
    """A namespace nobody else uses."""
    name = "t" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE NAMESPACE {name}")
    return name


@pytest.fixture
def rows(spark):
    """Build a frame from tuples and a DDL schema; collect a frame as a sorted list."""
    class Rows:
        @staticmethod
        def make(data, schema):
            return spark.createDataFrame(data, schema)

        @staticmethod
        def of(df):
            return sorted((tuple(r) for r in df.collect()), key=repr)
    return Rows
