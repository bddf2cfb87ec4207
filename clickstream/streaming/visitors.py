"""Page views and unique visitors of a stream, exact."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickstream.functions.parse import identified, parse_log, valid
from clickstream.operators.sales import ALL
from clickstream.schema import MONEY_SUM
from clickstream.streaming import commits as log
from clickstream.streaming.batches import BATCH_INTERVAL, each_batch
from clickstream.streaming.kpis import STATE_PARTITIONS, _shuffle_partitions
from clickstream.streaming.sinks import kpi_increments, kpi_sink, remove_remains


def _key(by_day: bool) -> Column:
    return F.col("dt").cast("string") if by_day else F.lit(ALL)


def _known(lines: DataFrame, by_day: bool) -> DataFrame:
    return identified(valid(parse_log(lines, ["openid", "time"] if by_day else ["openid"])))


def _once_per_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different rows of each part of a task, so that a frequent visitor is few rows."""
    for batch in batches:
        different = pa.Table.from_batches([batch]).group_by(batch.schema.names).aggregate([])
        yield from different.select(batch.schema.names).combine_chunks().to_batches()


def first_visits(lines: DataFrame, by_day: bool = False, keep_days: int | None = None) -> DataFrame:
    """The first row of each known visitor in a stream, or of each visitor and day: `key`, `openid`.

    The state has a row for each, for ever, unless `keep_days` is given: then days that ended so long
    before the newest day did are forgotten, and what comes later for them is not counted.
    """
    if keep_days is not None and not by_day:
        raise ValueError("only visitors of a day can be forgotten")
    rows = _known(lines, by_day).select(_key(by_day).alias("key"), "openid")
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = rows.mapInArrow(_once_per_part, rows.schema)
    if keep_days is None:
        return rows.dropDuplicates(["key", "openid"])
    ended = F.col("key").try_cast("timestamp") + F.expr("INTERVAL 1 DAY")
    rows = rows.withColumn("ended", ended).withWatermark("ended", f"{keep_days} days")
    return rows.dropDuplicates(["key", "openid", "ended"]).select("key", "openid")


def run_visitors(
    lines: DataFrame,
    table: str,
    checkpoint: str,
    by_day: bool = False,
    keep_days: int | None = None,
    trigger: dict | None = None,
    compact_every: int = 100,
    state_partitions: int | None = STATE_PARTITIONS,
) -> StreamingQuery:
    """Start a query that counts the different visitors in `lines.value`, in all or by day.

    The table (read it with `latest_kpis`) has the indicator "uv" with the key "all", or a row for
    each day. Visitors are told apart exactly: they are the state, first visits are counted per
    batch, and the counts are added to the table. A batch that runs again finds the state and the
    table of the batch before. With many visitors set RocksDB as the session's state store and
    `state_partitions` to some times the number of cores. A table belongs to one checkpoint.
    """
    add = kpi_increments(table, compact_every)

    def count(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("key").agg(F.count(F.lit(1)).cast(MONEY_SUM).alias("value"))
        add(counts.withColumn("kpi", F.lit("uv")).select("kpi", "key", "value"), batch_id)

    visits = first_visits(lines, by_day, keep_days)
    return _started(visits, "append", count, table, checkpoint, trigger, state_partitions)


def run_views(
    lines: DataFrame,
    table: str,
    checkpoint: str,
    by_day: bool = False,
    trigger: dict | None = None,
    compact_every: int = 100,
    state_partitions: int | None = STATE_PARTITIONS,
) -> StreamingQuery:
    """As `run_visitors`, for the views of known visitors: the indicator "pv"."""
    views = _known(lines, by_day).groupBy(F.lit("pv").alias("kpi"), _key(by_day).alias("key"))
    counts = views.agg(F.count(F.lit(1)).cast(MONEY_SUM).alias("value"))
    sink = kpi_sink(table, compact_every)
    return _started(counts, "update", sink, table, checkpoint, trigger, state_partitions)


def _started(
    rows: DataFrame, mode: str, step, table: str, checkpoint: str, trigger, state_partitions
) -> StreamingQuery:
    spark = rows.sparkSession
    log.check_owner(spark, table, checkpoint)
    remove_remains(spark, table)
    writer = (
        rows.writeStream.outputMode(mode)
        .foreachBatch(each_batch(step, skip_empty=False))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or BATCH_INTERVAL))
    )
    with _shuffle_partitions(spark, state_partitions):
        return writer.start()
