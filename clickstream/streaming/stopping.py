"""Stopping a stream after the batch that runs, by a marker on shared storage."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickstream.storage import create, delete, exists
from clickstream.streaming.batches import Step

TOLD = "told to stop before this batch"


class Stopped(RuntimeError):
    pass


def request_stop(spark: SparkSession, marker: str) -> None:
    """Leaves the marker, from any process that reaches the storage."""
    create(spark, marker, b"")


def stop_at(marker: str) -> Step:
    """The first step of a batch: does nothing of it once there is the marker.

    The batch before is finished and committed by then, and this one runs whole after a restart.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        if exists(batch.sparkSession, marker):
            raise Stopped(TOLD)

    step.on_empty = True
    return step


def await_stop(query: StreamingQuery, marker: str, poll_seconds: float = 1.0) -> bool:
    """Waits until the query ends; true if it was told to by the marker, which is then removed.

    The query's batches begin with `stop_at(marker)`. A running batch is waited for; a stream without
    new data is stopped between two looks for some. Any other end is that of the query.
    """
    spark = SparkSession.active()
    try:
        while not query.awaitTermination(poll_seconds):
            # No batch that begins after the marker is there does anything, so it may be cut off.
            if exists(spark, marker) and not query.status["isTriggerActive"]:
                query.stop()
    except StreamingQueryException as error:
        if TOLD not in str(error):
            raise
    told = exists(spark, marker)
    if told:
        delete(spark, marker)
    return told
