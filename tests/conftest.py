import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("clickstream-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """A DataFrame of raw lines; a dict becomes its JSON text."""

    def make(*values):
        texts = [(v if isinstance(v, str) else json.dumps(v),) for v in values]
        return spark.createDataFrame(texts, "value string")

    return make


@pytest.fixture
def records(lines):
    """Valid typed records from dicts."""
    from clickstream import parse_log, valid

    return lambda *values: valid(parse_log(lines(*values)))


def rows(df, *columns):
    """The rows as a list of tuples in a stable order."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in df.collect()), key=repr)
