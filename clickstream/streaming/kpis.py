"""Sales indicators accumulated over a stream of log lines."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickstream.functions.parse import parse_log, valid
from clickstream.operators.sales import KPIS, code_kpis, labelled_kpis
from clickstream.schema import LOG_FIELDS
from clickstream.streaming import commits as log
from clickstream.streaming.batches import (
    BATCH_INTERVAL,
    Step,
    each_batch,
    quarantine,
    record_offsets,
    write_batch,
)
from clickstream.streaming.sinks import (
    hand_over_kpis,
    kpi_increments,
    kpi_sink,
    latest_kpis,
    remove_remains,
)
from clickstream.streaming.stopping import stop_at

STATE_PARTITIONS = 8


def run_kpis(
    lines: DataFrame,
    table: str,
    checkpoint: str,
    kpis=tuple(KPIS),
    dim: DataFrame | None = None,
    event_types=None,
    trigger: dict | None = None,
    compact_every: int = 100,
    state_partitions: int | None = STATE_PARTITIONS,
    query_name: str | None = None,
    also: Sequence[Step] = (),
    take_over: bool = False,
    stop_marker: str | None = None,
) -> StreamingQuery:
    """Start a query that sums the sales in `lines.value` and keeps the table up to date.

    One query computes all `kpis`: the lines are read and parsed once, and only the fields the
    indicators need. The sums are state in the checkpoint, so a restart goes on where the last
    finished batch ended. They have no watermark: late records count, and the state is no
    larger than the table. "Today" is the row of the day, so nothing is reset at midnight.

    `trigger` is a dict of `trigger()` arguments, every two seconds by default.
    `state_partitions` sets the number of state partitions for this query alone; None takes
    the session's shuffle partitions. The state is small and every partition costs a task and
    a state file per batch, so few are best even on a large cluster. Spark fixes the number
    when a checkpoint is new.

    The state has sales by category code, and only the codes that a batch changed are labelled,
    for `also`: functions of `(changed_rows, batch_id)` that run after the table is written,
    for instance to push the changed indicators to a key/value store.

    A table belongs to one checkpoint and one running query; with another checkpoint a filled
    table is refused. `take_over` hands it over to this new checkpoint: its values go on growing
    from what they are, and the query that owned it can no longer write. The caller has
    the stream start after what the table holds. With a `stop_marker`, wait by `await_stop`.
    """
    spark = lines.sparkSession
    if take_over and log.checkpoint_id(spark, checkpoint) is None:
        hand_over_kpis(spark, table)
    log.check_owner(spark, table, checkpoint)
    remove_remains(spark, table)
    fields = ["total_money", *(KPIS[kpi] for kpi in kpis if KPIS[kpi])]
    if event_types is not None:
        fields.append("event_type")
    values = code_kpis(valid(parse_log(lines, fields)), kpis, event_types)
    steps = [stop_at(stop_marker)] if stop_marker else []
    steps += [kpi_sink(table, compact_every), *(_with_labels(step, table, dim) for step in also)]
    writer = (
        values.writeStream.outputMode("update")
        .foreachBatch(each_batch(*steps, skip_empty=False))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or BATCH_INTERVAL))
    )
    if query_name:
        writer = writer.queryName(query_name)
    with _shuffle_partitions(spark, state_partitions):
        return writer.start()


def _with_labels(step: Step, table: str, dim: DataFrame | None) -> Step:
    """The step on the current values of the labels that the batch changed."""

    def run(batch: DataFrame, batch_id: int) -> None:
        changed = labelled_kpis(batch.select("kpi", "key", "value"), dim)
        changed = changed.select(F.col("kpi").alias("_kpi"), F.col("key").alias("_key"))
        same = F.expr("kpi = _kpi AND key <=> _key")
        latest = latest_kpis(batch.sparkSession, table, dim=dim)
        step(latest.join(changed, same, "left_semi"), batch_id)

    return run


def run_job(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    offsets_path: str | None = None,
    malformed_path: str | None = None,
    raw_path: str | None = None,
    kpis=tuple(KPIS),
    event_types=None,
    trigger: dict | None = None,
    compact_every: int = 100,
    query_name: str | None = None,
    take_over: bool = False,
    stop_marker: str | None = None,
) -> StreamingQuery:
    """Start one query that does all of the streaming job on each batch of Kafka records.

    The batch is read and parsed once and kept for its steps: the sales indicators (`table`, read
    it with `latest_kpis`), and as far as paths are given the offset ranges, the malformed lines
    and the archive of the records by day (read them with `batch_table`). All have one checkpoint
    and so the same batches. Sums of the batch are added to the table's values: the table is
    the state, and nothing is kept per key elsewhere. The offset ranges are recorded last, so a
    batch whose ranges are there is in all tables.

    Tables belong to one checkpoint; with another they are refused. If the checkpoint is lost, start
    a new one with `take_over` and the source at `next_offsets` of the recorded ranges: what a
    batch wrote that is not recorded is dropped from all tables, the sums go on, batches are
    numbered on, and the old query, should it still run, can no longer write. With a `stop_marker`,
    wait by `await_stop`.
    """
    spark = stream.sparkSession
    others = [path for path in (malformed_path, raw_path, offsets_path) if path]
    if take_over and log.checkpoint_id(spark, checkpoint) is None:
        if not offsets_path:
            raise ValueError("only a job with an offsets_path can be taken over")
        base = log.load(spark, offsets_path).last + 1
        hand_over_kpis(spark, table, base)
        for path in others:
            log.hand_over(spark, path, base)
    for path in (table, *others):
        log.check_owner(spark, path, checkpoint)
    remove_remains(spark, table)
    add = kpi_increments(table, compact_every)
    steps: list[Step] = [stop_at(stop_marker)] if stop_marker else []
    steps += [
        lambda batch, batch_id: add(code_kpis(valid(batch), kpis, event_types), batch_id)
    ]
    if malformed_path:
        steps.append(quarantine(malformed_path))
    if raw_path:
        steps.append(write_batch(raw_path, valid, by=["dt"]))
    if offsets_path:
        steps.append(record_offsets(offsets_path, checkpoint))
    # Only what the steps need is kept; the archive needs all fields.
    fields = LOG_FIELDS if raw_path else ["time", "cid", "province", "total_money", "event_type"]
    names = ["topic", "partition", "offset", "value"]
    parsed = parse_log(stream.select(*[n for n in names if n in stream.columns]), fields)
    writer = (
        parsed.writeStream.foreachBatch(_kept(each_batch(*steps)))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or BATCH_INTERVAL))
    )
    return (writer.queryName(query_name) if query_name else writer).start()


def _kept(step: Step) -> Step:
    """The step on a batch that is parsed once, whatever is asked of it."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    return run


@contextmanager
def _shuffle_partitions(spark: SparkSession, number: int | None):
    """The setting for a query that starts meanwhile; a query keeps the settings of its start."""
    setting = "spark.sql.shuffle.partitions"
    if number is None:
        yield
        return
    before = spark.conf.get(setting)
    spark.conf.set(setting, number)
    try:
        yield
    finally:
        spark.conf.set(setting, before)
