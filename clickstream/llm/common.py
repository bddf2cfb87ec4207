"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

import clickstream
from clickstream.storage import create, delete, scratch_dir

# The white space of the contracts, as a character class for Java's patterns.
BLANK = r"[\x20\x09-\x0D]"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet below the shared `spark.checkpoint.dir` and read again.

    Cuts the lineage: a lost executor costs its running tasks, not the steps before.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise_alone(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Like `materialise`, and the shuffles that made the rows leave the disk at once.

    Else Spark keeps them until the driver collects garbage. Nothing cached may build on them.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*written: DataFrame) -> None:
    """Deletes what `materialise` wrote for these, once nothing reads them any more."""
    for df in written:
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            delete(df.sparkSession, folder)


def ship(spark: SparkSession) -> None:
    """Makes this package known to the Python workers, which need not have it installed."""
    context, package = spark.sparkContext, Path(clickstream.__file__).parent
    if getattr(context, "_ships_clickstream", False) or not package.is_dir():
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, f"clickstream/{file.relative_to(package)}")
    path = f"{scratch_dir(spark, 'package')}/clickstream.zip"
    create(spark, path, archive.getvalue())
    context.addPyFile(path)
    context._ships_clickstream = True


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions, which the user sets in proportion to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text") -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key under which what is found in a row is joined back to it.

    Rows of the same id and text share it and have the same results; rows that repeat an id with
    another text do not.
    """
    return F.xxhash64(F.col(doc_id), F.col(text))


def own_columns(docs: DataFrame) -> list[Column]:
    """All columns of `docs`, told apart from those of what it is joined with."""
    return [docs[f"`{name}`"] for name in docs.columns]


def same_row(docs: DataFrame, found: DataFrame) -> Column:
    """Whether a row of `docs` is the one that `doc_id` and `row` of `found` stand for."""
    key = F.xxhash64(docs["doc_id"], docs["text"])
    return docs["doc_id"].eqNullSafe(found["doc_id"]) & (key == found["row"])


def found_rows(found: DataFrame, *more: str) -> DataFrame:
    """`doc_id`, `row` and `more`, renamed to themselves: a join with their source is no riddle."""
    return found.select(*[F.col(name).alias(name) for name in ("doc_id", "row", *more)])


def rows_without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of `docs` that `gone`, with `doc_id` and `row`, does not list."""
    gone = found_rows(gone)
    return docs.join(gone, same_row(docs, gone), "left_anti")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Adds a gapless number from 0 within each group, in no task more than a share of a group.

    Rows are numbered within (group, salt) and moved by the number of rows of the group's lower
    salts. `df` is read twice and must give the same rows: materialise it first. The columns of
    `groups` hold no nulls.
    """
    salts = 2 * partitions(df.sparkSession)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    in_salt = Window.partitionBy(*groups, "_salt").orderBy(*order)
    below = Window.partitionBy(*groups).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        salted.groupBy(*groups, "_salt")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*groups, "_salt", F.coalesce(F.sum("_rows").over(below), F.lit(0)).alias("_below"))
    )
    number = (F.col("_below") + F.col("_number") - 1).alias(name)
    return (
        salted.withColumn("_number", F.row_number().over(in_salt))
        .join(offsets, [*groups, "_salt"])
        .select(*df.columns, number)
    )
