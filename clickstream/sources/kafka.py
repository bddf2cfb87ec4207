"""The Kafka source. The session must have the public `spark-sql-kafka-0-10` package."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickstream.operators.offsets import starting_offsets_json
from clickstream.storage import exists, read

# Fixed value: records a second read from each partition.
MAX_RATE_PER_PARTITION = 1000


def rate_cap(partitions: int, seconds: float, per_second: int = MAX_RATE_PER_PARTITION) -> int:
    """The per-partition rate as records per batch, the unit of `max_per_trigger`."""
    return int(per_second * seconds * partitions)


def kafka_options(
    brokers,
    topics,
    starting: str | DataFrame = "earliest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
    group: str | None = None,
) -> dict[str, str]:
    """Options of the Kafka source. `topics` is a name or a list of names.

    `starting` is "earliest", "latest" or saved positions, as a DataFrame for
    `starting_offsets_json` or as its JSON; Spark wants all partitions of the topics in it. It
    serves the first start only; afterwards the checkpoint says where to go on.
    `min_partitions` makes Spark read long partitions in several tasks, so that a topic
    partition with much of the data does not become one long task.
    """
    if isinstance(starting, DataFrame):
        starting = starting_offsets_json(starting).first().starting_offsets
    options = {
        "kafka.bootstrap.servers": brokers if isinstance(brokers, str) else ",".join(brokers),
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": max_per_trigger,
        "minPartitions": min_partitions,
        "kafka.group.id": group,
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def kafka_source(spark: SparkSession, brokers, topics, *args, **options) -> DataFrame:
    """Stream of the records of `topics` as `envelope` gives them; see `kafka_options`."""
    source = kafka_options(brokers, topics, *args, **options)
    return envelope(spark.readStream.format("kafka").options(**source).load())


def envelope(df: DataFrame) -> DataFrame:
    """Kafka's binary key and value as text, with the coordinates of the record."""
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )


RANGES = "topic string, partition int, from_offset bigint, until_offset bigint"


def consumed_ranges(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame | None:
    """What a batch of the query was planned to read of each partition, from its offset log.

    One row per topic and partition that the source knew, also where it read nothing. A partition
    that the batch before did not know starts at the position that the source began with, or at 0.
    None if no source of the query has positions by topic and partition.
    """
    ends = _positions(spark, f"{checkpoint}/offsets/{batch_id}")
    starts = _positions(spark, f"{checkpoint}/offsets/{batch_id - 1}") if batch_id else {}
    rows = []
    for source, end in sorted(ends.items()):
        initial = _positions(spark, f"{checkpoint}/sources/{source}/0", skip=1).get(0, {})
        start = initial | starts.get(source, {})
        rows += [(*key, start.get(key, 0), until) for key, until in sorted(end.items())]
    return spark.createDataFrame(rows, RANGES) if ends else None


def _positions(spark: SparkSession, file: str, skip: int = 2) -> dict[int, dict]:
    """By number of the source: offset by topic and partition. `skip` lines come before them."""
    if not exists(spark, file):
        return {}
    found = {}
    for source, line in enumerate(read(spark, file).decode().split("\n")[skip:]):
        try:
            topics = json.loads(line)
            positions = {
                (topic, int(partition)): int(offset)
                for topic, partitions in topics.items()
                for partition, offset in partitions.items()
            }
        except (ValueError, AttributeError, TypeError):
            continue  # a source of another kind
        if positions:
            found[source] = positions
    return found


def next_offsets(ranges: DataFrame) -> DataFrame:
    """Where to go on after the recorded `ranges`: the `starting` positions of `kafka_options`."""
    return ranges.groupBy("topic", "partition").agg(F.max("until_offset").alias("offset"))
