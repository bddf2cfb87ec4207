"""A log made of the given tables: events with their customer, nation and region.

Spark derives it from whole tables. `FIXTURES.md` lists the columns and the defects.
"""

from __future__ import annotations

import json
import os
import sys
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from clickstream.operators.offsets import offset_ranges
from clickstream.schema import LOG_FIELDS, TIME_FORMAT
from clickstream.storage import create, exists, scratch_dir

# Lines of the matrix of malformed lines.
MALFORMED = [
    '{"time":"2024-01-05 10:00:00","page":"/p/1","openid":"u1","event_type":1,'
    '"province":"ASIA","city":"CHINA","cid":"1","pid":"1","total_money":10}',
    '{"openid":"u2","event_type":"1","total_money":"7"}',
    "not json",
    "",
    '{"event_type":2}',
    "[1]",
    "null",
    '{"openid":"u3","total_money":1.5}',
    '{"openid":null}',
    '{"openid":3,"total_money":99999999999}',
    '{"openid":"u4"} trailing',
    '{"openid":"u5"',
]

# Event codes; only that of a view is given, the others are ours.
EVENT_TYPES = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 5}

_landed: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clean record per event, with `event_id` and `ts`."""
    # One lookup after the other: Spark knows the size of each table and broadcasts the small
    # ones, which it cannot tell of a join of them.
    events = (
        table(spark, sf_dir, "events")
        .join(table(spark, sf_dir, "customer"), F.expr("user_id = c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    pid = F.get_json_object("props", "$.k")
    event_type = F.create_map(*[F.lit(x) for pair in EVENT_TYPES.items() for x in pair])
    known = F.expr("event_id % 13 <> 0")
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.date_format("ts", TIME_FORMAT).alias("time"),
        F.concat(F.lit("/p/"), pid).alias("page"),
        F.when(known, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("openid"),
        event_type[F.col("event_type")].alias("event_type"),
        F.col("r_name").alias("province"),
        F.col("n_name").alias("city"),
        (pid.cast("int") % 5 + 1).cast("string").alias("cid"),
        pid.alias("pid"),
        F.col("value").cast("decimal(18,2)").alias("total_money"),
    )


def kafka_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as Kafka would deliver it, some lines blank or cut off."""
    log = log_from_events(spark, sf_dir)
    text = F.to_json(F.struct(*LOG_FIELDS))
    line = (
        F.when(F.expr("event_id % 101 = 0"), F.lit(""))
        .when(F.expr("event_id % 97 = 0"), F.substring(text, 1, 12))
        .otherwise(text)
    )
    return log.select(
        F.lit(None).cast("binary").alias("key"),
        line.cast("binary").alias("value"),
        F.lit("access").alias("topic"),
        F.expr("cast(event_id % 3 AS int)").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka_log(spark, sf_dir).select(F.col("value").cast("string").alias("value"))


def landed_lines(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the raw lines as text files, written once per session."""
    return _land(spark, sf_dir, "lines", lambda df, path: df.write.text(path), raw_lines)


def landed_kafka(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the Kafka-shaped log in Parquet, a folder per Kafka partition."""

    def write(df: DataFrame, path: str) -> None:
        df.write.partitionBy("partition").parquet(path)

    return _land(spark, sf_dir, "kafka", write, kafka_log)


def landed_stream(spark: SparkSession, sf_dir: str, batches: int = 3) -> DataFrame:
    """The landed Kafka-shaped log as a stream of about `batches` micro-batches."""
    path = landed_kafka(spark, sf_dir)
    landed = spark.read.parquet(path)
    share = -(-len(landed.inputFiles()) // batches)
    reader = spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", share)
    return reader.parquet(path)


def replayed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a stream of some batches, which then gives all of it again, ten days later."""
    path = scratch_dir(spark, "replayed")
    log = spark.read.parquet(landed_kafka(spark, sf_dir))
    later = log.withColumn("timestamp", F.expr("timestamp + INTERVAL 10 DAYS"))
    for n, part in enumerate((log, later)):
        part.repartition(2).write.parquet(f"{path}/replay={n}")
    reader = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{path}/replay=*")


class GrowingLog:
    """A log file that takes over the landed lines, some at a time, and is rotated by renaming."""

    def __init__(self, landed: str, folder: str):
        self.parts = sorted(_local(landed).glob("part-*"))
        self.folder = _local(folder)
        self.folder.mkdir(parents=True)
        self.path = f"{self.folder}/access.log"

    def append(self, begin: float, end: float) -> None:
        """The lines from this to that share of each part."""
        with open(self.path, "ab") as log:
            for part in self.parts:
                lines = part.read_bytes().splitlines(keepends=True)
                log.writelines(lines[int(begin * len(lines)) : int(end * len(lines))])

    def size(self) -> int:
        return os.path.getsize(self.path)

    def rotate(self) -> None:
        os.rename(self.path, f"{self.path}.1")


def _local(path: str) -> Path:
    return Path(urlsplit(path).path)


def _land(spark, sf_dir, kind, write, source) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _landed or not exists(spark, f"{_landed[key]}/_SUCCESS"):
        path = scratch_dir(spark, kind)
        write(source(spark, sf_dir), path)
        _landed[key] = path
    return _landed[key]


class LandedLog(DataSource):
    """The landed Kafka-shaped log as a stream with Kafka's offsets: JSON by topic and partition.

    Options: `path`; `ends` and `starts`, such JSON; `every`, of which offsets that are multiples are
    gone, as from a compacted topic. What a run finds is up to `ends`.
    """

    @classmethod
    def name(cls) -> str:
        return "landed_log"

    def schema(self) -> str:
        return (
            "key binary, value binary, topic string, partition int, offset bigint, "
            "timestamp timestamp"
        )

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LandedLogReader(self.options)


class LandedLogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.every = options["path"], int(options.get("every", 0))
        self.ends, self.starts = json.loads(options["ends"]), json.loads(options["starts"])

    def initialOffset(self) -> dict:
        return self.starts

    def latestOffset(self) -> dict:
        return self.ends

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [
            InputPartition((topic, int(number), start.get(topic, {}).get(number, 0), until))
            for topic, ends in end.items()
            for number, until in ends.items()
        ]

    def read(self, partition: InputPartition):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        topic, number, since, until = partition.value
        folder = f"{self.path}/partition={number}"
        if not os.path.isdir(folder):
            return
        offset = ds.field("offset")
        wanted = (offset >= since) & (offset < until)
        names = ["key", "value", "topic", "partition", "offset", "timestamp"]
        for batch in ds.dataset(folder, format="parquet").to_batches(filter=wanted):
            if self.every:
                left = pc.subtract(
                    batch["offset"],
                    pc.multiply(pc.divide(batch["offset"], self.every), self.every),
                )
                batch = batch.filter(pc.not_equal(left, 0))
            columns = {name: batch[name] for name in names if name != "partition"}
            columns["partition"] = pa.array([number] * batch.num_rows, pa.int32())
            columns["timestamp"] = columns["timestamp"].cast(pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([columns[name] for name in names], names)


def partitioned_log(
    spark: SparkSession, sf_dir: str, checkpoint: str, ends: dict, starts: dict | None = None, every: int = 0
) -> DataFrame:
    """The log as a stream of a source with positions by topic and partition.

    As Kafka's source does, the positions it starts with are left in a new checkpoint.
    """
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LandedLog)
    starts = json.dumps(starts or {topic: dict.fromkeys(found, 0) for topic, found in ends.items()})
    if not exists(spark, f"{checkpoint}/sources/0/0"):
        create(spark, f"{checkpoint}/sources/0/0", b"\0v1\n" + starts.encode())
    reader = spark.readStream.format("landed_log").option("path", str(_local(landed_kafka(spark, sf_dir))))
    options = {"ends": json.dumps(ends), "starts": starts, "every": str(every)}
    return reader.options(**options).load()


def log_ends(spark: SparkSession, sf_dir: str, share: float = 1.0) -> dict:
    """The topic's end positions, or those that this share of each partition reaches."""
    ranges = offset_ranges(spark.read.parquet(landed_kafka(spark, sf_dir))).collect()
    return {"access": {str(r.partition): int(r.until_offset * share) for r in ranges}}
