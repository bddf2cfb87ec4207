"""The jobs as a whole: two batch reports on a log and one streaming job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickstream.functions.parse import malformed, parse_log, valid
from clickstream.operators.ranking import top_products
from clickstream.operators.traffic import (
    area_distribution,
    areas_of,
    pv_uv_raw,
    pv_uv_raw_of,
    traffic_report,
    visitor_provinces,
    visits,
)
from clickstream.sources.files import read_json, read_lines
from clickstream.sources.kafka import kafka_source
from clickstream.streaming.kpis import run_job


def line_report(
    spark: SparkSession, path, dim: DataFrame | None = None, share: bool = False
) -> dict[str, DataFrame]:
    """Report on raw lines: `traffic`, `areas`, `top_products` and `malformed`, all lazy.

    Each scans the log once and parses only the fields it needs. With `share` the first two
    come from `visits`, also in the result and kept on first use, with one scan between them.
    That pays where a visitor has many lines, `visits` then being small; `unpersist` it after.
    """
    lines = read_lines(spark, path)
    views = valid(parse_log(lines, fields=["openid", "event_type", "cid", "pid"]))
    rankings = {
        "top_products": top_products(views, dim),
        "malformed": malformed(parse_log(lines, fields=())),
    }
    if share:
        counted = visits(lines).persist()
        traffic = {"traffic": pv_uv_raw_of(counted), "areas": areas_of(counted)}
        return traffic | rankings | {"visits": counted}
    records = valid(parse_log(lines, fields=["openid", "province", "city"]))
    return {"traffic": pv_uv_raw(lines), "areas": area_distribution(records)} | rankings


def sql_report(
    spark: SparkSession, path, report_time=None, limit: int | None = None
) -> dict[str, DataFrame]:
    """Report on JSON records, in SQL: `traffic` and `visitor_provinces`, the first `limit` of them
    if given."""
    log = read_json(spark, path)
    return {
        "traffic": traffic_report(log, report_time),
        "visitor_provinces": visitor_provinces(log, limit),
    }


def kafka_kpis(
    spark: SparkSession,
    brokers,
    topics,
    table: str,
    checkpoint: str,
    source: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start the streaming job on Kafka topics: see `run_job`.

    `source` holds arguments of `kafka_options`, `options` are those of `run_job`: the indicators,
    the offset ranges, the malformed lines and the archive come from one read of each batch.
    """
    stream = kafka_source(spark, brokers, topics, **(source or {}))
    return run_job(stream, table, checkpoint, **options)
