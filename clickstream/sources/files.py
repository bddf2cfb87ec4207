"""Log files in any file system Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from clickstream.functions.parse import typed
from clickstream.schema import LOG


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Every line of the files as `value`, blank ones included."""
    return spark.read.text(path)


def read_json(spark: SparkSession, path, schema: T.StructType | None = LOG) -> DataFrame:
    """Records of JSON-lines files.

    Blank lines give no row, malformed ones a row of nulls. Only the fields a query uses are
    parsed, and its filters are applied while parsing. The declared schema saves the extra
    pass that inference takes over the whole log; `schema=None` asks for inference.
    """
    if schema is None:
        return spark.read.json(path)
    return typed(spark.read.schema(schema).json(path))


def stream_lines(spark: SparkSession, path, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the lines of files that appear in `path`, for files that no longer grow."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)
