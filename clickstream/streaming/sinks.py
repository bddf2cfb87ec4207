"""The indicator table and how a stream keeps it.

Rows are `(kpi, key, value, batch_id)`, partitioned by `batch_id`. A batch writes the keys it
changed with their absolute values, never increments, and overwrites its own partition, so a
batch that runs again after a failure leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickstream.operators.sales import labelled_kpis
from clickstream.schema import MONEY_SUM
from clickstream.storage import create, delete, exists, names, partition_values
from clickstream.streaming import commits as log

_VALUES = f"kpi string, key string, value {MONEY_SUM}"
KPI_SCHEMA = f"{_VALUES}, batch_id bigint"


def kpi_sink(path: str, compact_every: int = 100) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that writes `(kpi, key, value)` rows to the table at `path`.

    Every `compact_every` batches the partition holds the latest value of every key instead of
    the changed ones. Once a second such whole partition is finished, a later batch, of this run or
    another, removes what is older than the first. So the table stays at about twice
    `compact_every` folders, and a reader has that many batches before folders it has listed go.

    The values are those of the query's state. In a table that was handed over, they are added to
    what it held then.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = log.claim(spark, path, log.load(spark, path)).base
        _remove_old(spark, path, base + batch_id)
        changed = batch.select("kpi", "key", "value")
        if base:
            changed = _added(changed, _carried(spark, path, base))
        _write(changed, path, base + batch_id, compact_every)

    return write


def _write(changed: DataFrame, path: str, number: int, compact_every: int) -> None:
    spark = changed.sparkSession
    whole = number > 0 and number % compact_every == 0
    if whole:
        changed = _latest(
            _table(spark, path)
            .filter(F.col("batch_id") < number)
            .unionByName(changed.withColumn("batch_id", F.lit(number).cast("bigint")))
        )
    (
        changed.withColumn("batch_id", F.lit(number).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )
    if whole:
        create(spark, f"{path}/{WHOLE}/{number}", b"")


def _added(sums: DataFrame, before: DataFrame) -> DataFrame:
    """The keys of `sums`, with what was there before."""
    before = before.withColumnRenamed("value", "before")
    same = sums["kpi"].eqNullSafe(before["kpi"]) & sums["key"].eqNullSafe(before["key"])
    value = F.coalesce(F.col("value") + F.col("before"), "value", "before")
    return sums.join(before, same, "left").select(
        sums["kpi"], sums["key"], value.cast(MONEY_SUM).alias("value")
    )


def _carried(spark: SparkSession, path: str, base: int) -> DataFrame:
    """The values before the batch `base`, kept apart as old partitions go."""
    kept = f"{path}/{CARRIED}/{base}"
    if not exists(spark, f"{kept}/_SUCCESS"):
        before = _latest(_table(spark, path).filter(F.col("batch_id") < base))
        before.write.mode("overwrite").parquet(kept)
    return spark.read.schema(_VALUES).parquet(kept)


def kpi_increments(path: str, compact_every: int = 100) -> Callable[[DataFrame, int], None]:
    """As `kpi_sink`, for the sums of the batch alone: they are added to the table's values.

    What earlier batches left is the state, so a batch that runs again finds the same as before, and
    a table that was handed over goes on with its sums.
    """

    def add(sums: DataFrame, batch_id: int) -> None:
        spark = sums.sparkSession
        number = log.claim(spark, path, log.load(spark, path)).base + batch_id
        _remove_old(spark, path, number)  # before the table is listed
        if partition_values(spark, path, "batch_id"):
            sums = _added(sums, _latest(_table(spark, path).filter(F.col("batch_id") < number)))
        _write(sums.select("kpi", "key", "value"), path, number, compact_every)

    return add


def hand_over_kpis(spark: SparkSession, path: str, base: int | None = None) -> None:
    """Opens the table to a new checkpoint; what batches from `base` on wrote is dropped."""
    numbers = partition_values(spark, path, "batch_id")
    base = base if base is not None else max(numbers, default=-1) + 1
    log.hand_over(spark, path, base)
    for number in numbers:
        if number >= base:
            delete(spark, f"{path}/{WHOLE}/{number}")
            delete(spark, f"{path}/batch_id={number}")


# Below it the values that a table had when it was handed over, by the number of the batch.
CARRIED = "_carried"
# Below it an empty file for each whole partition that is finished.
WHOLE = "_whole"


def _remove_old(spark: SparkSession, path: str, batch_id: int) -> None:
    """Removes what is older than the last but one whole partition before this batch."""
    finished = sorted(int(name) for name in names(spark, f"{path}/{WHOLE}") if int(name) < batch_id)
    if len(finished) < 2:
        return
    for old in partition_values(spark, path, "batch_id"):
        if old < finished[-2]:
            delete(spark, f"{path}/batch_id={old}")
    for old in finished[:-2]:
        delete(spark, f"{path}/{WHOLE}/{old}")


def remove_remains(spark: SparkSession, path: str) -> None:
    """Remove what a killed writer of the table left. The table must have no writer now."""
    for name in names(spark, path):
        if name.startswith(".spark-staging-"):
            delete(spark, f"{path}/{name}")


def latest_kpis(
    spark: SparkSession, path: str, zero_if_empty: bool = False, dim: DataFrame | None = None
) -> DataFrame:
    """The current `(kpi, key, value)` rows; `zero_if_empty` shows a null value as 0.

    The table has sales by category code; they get their labels here, from `dim` or the fixed
    table, and what shares a label is added up.
    """
    latest = labelled_kpis(_latest(_table(spark, path)), dim)
    if zero_if_empty:
        latest = latest.withColumn("value", F.coalesce("value", F.lit(0).cast(MONEY_SUM)))
    return latest


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KPI_SCHEMA).parquet(path)


def _latest(table: DataFrame) -> DataFrame:
    return table.groupBy("kpi", "key").agg(F.max_by("value", "batch_id").alias("value"))
