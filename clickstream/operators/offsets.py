"""Operators on records in a Kafka envelope: key, value, topic, partition, offset, timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def offset_ranges(batch: DataFrame) -> DataFrame:
    """The offsets `batch` covers per topic and partition, `until_offset` being exclusive."""
    return batch.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def dedup_offsets(df: DataFrame, within: str | None = None) -> DataFrame:
    """One row per topic, partition and offset, for records that were delivered again.

    A stream needs `within`, an interval such as "1 hour", or its state would never end: records
    that come again within it after the first, by their `timestamp`, are dropped, and the
    state of a record goes once the stream is past it.
    """
    keys = ["topic", "partition", "offset"]
    if not df.isStreaming:
        return df.dropDuplicates(keys)
    if within is None:
        raise ValueError("on a stream, say within which interval records come again")
    return df.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(keys)


def starting_offsets_json(offsets: DataFrame) -> DataFrame:
    """One row, one column `starting_offsets`: the Kafka source's JSON of where to start.

    `offsets` has `topic`, `partition` and `offset`, the next offset to read. If a partition
    is listed more than once, its furthest position counts. The result is as large as the
    list of partitions.
    """
    furthest = offsets.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    positions = F.transform(
        F.sort_array(F.collect_list(F.struct("partition", "offset"))),
        lambda p: F.struct(p["partition"].cast("string"), p["offset"]),
    )
    topics = furthest.groupBy("topic").agg(F.map_from_entries(positions).alias("positions"))
    entries = F.map_from_entries(F.collect_list(F.struct("topic", "positions")))
    return topics.agg(F.to_json(entries).alias("starting_offsets"))
