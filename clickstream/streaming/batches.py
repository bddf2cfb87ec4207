"""Any computation on each micro-batch of a stream."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickstream.functions.parse import malformed, parse_log
from clickstream.operators.offsets import offset_ranges
from clickstream.sources.kafka import consumed_ranges
from clickstream.storage import delete, names, size
from clickstream.streaming import commits as log

Step = Callable[[DataFrame, int], None]

# Fixed value: the interval between batches.
BATCH_INTERVAL = {"processingTime": "2 seconds"}


def each_batch(*steps: Step, skip_empty: bool = True) -> Step:
    """A `foreachBatch` function that runs every step on the batch.

    If there are several steps the batch is kept for them, so the source is read once. An empty
    batch is skipped, but for steps that are marked `on_empty`; the look whether it is empty reads
    a little of a batch that is not kept, so it must be turned off after a stateful operator.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        shared = len(steps) > 1
        if shared:
            batch.persist()
        try:
            empty = skip_empty and batch.isEmpty()
            for step in steps:
                if not empty or getattr(step, "on_empty", False):
                    step(batch, batch_id)
        finally:
            if shared:
                batch.unpersist()

    return run


def run_batches(
    stream: DataFrame, checkpoint: str, *steps: Step, trigger: dict | None = None
) -> StreamingQuery:
    """Start a query that runs `steps` on every batch of `stream`.

    Tables of its steps must be new or of the same checkpoint.
    """
    for step in steps:
        if path := getattr(step, "path", None):
            log.check_owner(stream.sparkSession, path, checkpoint)
    return (
        stream.writeStream.foreachBatch(each_batch(*steps))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or BATCH_INTERVAL))
        .start()
    )


# Below it a folder for each batch or merge, whose name begins with the kind of its writer. To Spark
# the name is a value of a partition column, so that all of them are read as one table.
DATA, BATCH, MERGE = "data", "batch", "merge"
_FOLDER = "commit_folder"


def _place(path: str, folder: str) -> str:
    return f"{path}/{DATA}/{_FOLDER}={folder}"


def write_batch(
    path: str, transform: Callable[[DataFrame], DataFrame], by: Sequence[str] = ()
) -> Step:
    """A step that adds what `transform` makes of the batch to the table at `path`.

    Read the table with `batch_table`. A batch writes a folder of its own and then commits it to the
    table's log (`streaming.commits`), which alone says what the table holds: a batch that runs
    again finds itself committed and writes nothing, and what a killed one left is never read and is
    removed by the next run. An empty result is not committed. `by` names partition columns.
    `compact_table` merges small folders, at any time and in any process.
    """
    return _write_batch(path, lambda batch, batch_id: transform(batch), by)


def replace_table(
    path: str, transform: Callable[[DataFrame, DataFrame | None], DataFrame]
) -> Step:
    """A step that replaces the table at `path` by what `transform` makes of the batch and of the
    table as the batch before left it (None before the first). Read it with `batch_table`.

    The old folders of the last two batches stay for readers that have listed them.
    """

    def made(batch: DataFrame, batch_id: int) -> DataFrame:
        before = batch_table(batch.sparkSession, path)
        return transform(batch, None if before is None else before.drop("batch_id"))

    return _write_batch(path, made, replace=True)


def _write_batch(
    path: str,
    transform: Callable[[DataFrame, int], DataFrame],
    by: Sequence[str] = (),
    replace: bool = False,
) -> Step:
    known: list[log.Commits] = []  # what this run has read of the log

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not known:
            known.append(log.load(spark, path))
            log.claim(spark, path, known[0])
            _remove_remains(spark, path, known[0], BATCH)
        state = log.claim(spark, path, known[0])
        number = state.base + batch_id
        if number <= state.last:
            # Only what the query itself keeps of the batch is made again.
            batch.write.format("noop").mode("append").save()
            return
        folder = f"{BATCH}-{number}-{uuid.uuid4().hex}"
        place = _place(path, folder)
        rows = transform(batch, batch_id).withColumn("batch_id", F.lit(number).cast("bigint"))
        rows.write.partitionBy(*by).parquet(place)
        if spark.read.schema(rows.schema).parquet(place).isEmpty():
            delete(spark, place)
            return
        entry = {"add": {folder: (number, size(spark, place))}, "by": list(by)}
        if replace:
            entry |= {"remove": list(state.folders), "deleted": state.replaced[:-1]}
            for old in entry["deleted"]:
                delete(spark, _place(path, old))
        me = state.owner

        def decide(now: log.Commits) -> dict:
            if now.owner != me:
                raise ValueError(f"{path} was handed over to another checkpoint")
            return entry

        log.commit(spark, path, state, decide)

    step.path = path
    return step


def _remove_remains(spark: SparkSession, path: str, state: log.Commits, kind: str) -> None:
    """Removes folders of killed writers of this kind, of which no other may run now."""
    known = {*state.folders, *state.replaced}
    for name in names(spark, f"{path}/{DATA}"):
        folder = name.removeprefix(f"{_FOLDER}=")
        if folder.startswith(kind) and folder not in known:
            delete(spark, _place(path, folder))


def batch_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows that `write_batch` steps committed, with their `batch_id`; None before the first."""
    return _read(spark, path, list(log.load(spark, path).folders))


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame | None:
    paths = [_place(path, folder) for folder in sorted(folders)]
    if not paths:
        return None
    return spark.read.option("basePath", f"{path}/{DATA}").parquet(*paths).drop(_FOLDER)


def compact_table(spark: SparkSession, path: str, target_bytes: int = 128 << 20) -> int:
    """Merges the small folders of a batch table; returns how many there were.

    A job of its own, beside the running stream or after it; one at a time per table. Folders of
    consecutive batches are merged up to `target_bytes`, and folders of that size are never written
    again, so each row is rewritten few times however long the stream runs. The last batch is left
    alone. What was merged goes with the merge after the next, so that a reader that began before
    finds its files.
    """
    state = log.load(spark, path)
    _remove_remains(spark, path, state, MERGE)
    for folder in state.replaced:
        delete(spark, _place(path, folder))
    if state.replaced:
        gone = list(state.replaced)
        log.commit(spark, path, state, lambda now: {"deleted": gone})
    merged = 0
    for group in _groups(state, target_bytes):
        batch, whole = max(state.folders[f][0] for f in group), sum(state.folders[f][1] for f in group)
        folder = f"{MERGE}-{batch}-{uuid.uuid4().hex}"
        place = _place(path, folder)
        rows = _read(spark, path, group)
        if state.by:
            # A value with much of the rows is spread over as many tasks as fill a file each.
            share = F.pmod(F.spark_partition_id(), F.lit(1 + whole // target_bytes))
            rows = rows.repartition(*state.by, share)
        else:
            rows = rows.coalesce(1 + whole // target_bytes)
        rows.write.partitionBy(*state.by).parquet(place)
        entry = {"remove": group, "add": {folder: (batch, size(spark, place))}}

        def decide(now: log.Commits, entry=entry) -> dict | None:
            # Nothing to commit if the table was handed over without some of the batches.
            return entry if now.folders.keys() >= set(entry["remove"]) else None

        log.commit(spark, path, state, decide)
        merged += len(group)
    return merged


def _groups(state: log.Commits, target_bytes: int) -> list[list[str]]:
    groups, group, filled = [], [], 0
    small = [
        (batch, folder, bytes_)
        for folder, (batch, bytes_) in state.folders.items()
        if bytes_ < target_bytes and batch < state.last
    ]
    for _, folder, bytes_ in sorted(small):
        if group and filled + bytes_ > target_bytes:
            groups.append(group)
            group, filled = [], 0
        group.append(folder)
        filled += bytes_
    return [g for g in [*groups, group] if len(g) > 1]


def record_offsets(path: str, checkpoint: str | None = None) -> Step:
    """A step that records the offset ranges of each batch of Kafka records.

    With the query's `checkpoint` these are the ranges that the batch was planned for: gaps,
    partitions without records and batches without any are in them. Without it, or if the source has
    no positions by topic and partition, they are the offsets of the rows.
    """

    def ranges(batch: DataFrame, batch_id: int) -> DataFrame:
        planned = checkpoint and consumed_ranges(batch.sparkSession, checkpoint, batch_id)
        return planned or offset_ranges(batch)

    step = _write_batch(path, ranges)
    step.on_empty = True
    return step


def quarantine(path: str) -> Step:
    """A step that keeps the malformed lines of each batch with their coordinates.

    The batch may be parsed already; if not, each line is parsed once here.
    """

    def bad(batch: DataFrame) -> DataFrame:
        return malformed(batch if "ok" in batch.columns else parse_log(batch, fields=()))

    return write_batch(path, bad)


def archive(
    records: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: dict | None = None,
    files_per_day: int | None = None,
) -> StreamingQuery:
    """Start a query that appends parsed records to files partitioned by `dt`, each just once.

    Without `files_per_day` each task writes its rows as they are, with no shuffle, one file
    per day it meets. With it the rows are first spread over that many tasks per day: fewer
    files for the price of a shuffle, and never a whole day in one task.
    """
    if files_per_day is not None:
        part = F.pmod(F.spark_partition_id(), F.lit(files_per_day))
        records = records.repartition("dt", part)
    return (
        records.writeStream.format(fmt)
        .partitionBy("dt")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or BATCH_INTERVAL))
        .start()
    )
