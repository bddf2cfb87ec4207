"""Every operator as a query over the given tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import clickstream as cs
from checks import fixtures
from clickstream.storage import scratch_dir

AS_OF = "2024-01-30 18:00:00"
RANGE = ("2024-01-10 06:30:00", "2024-01-12 18:00:00")
NOW = {"availableNow": True}

Query = Callable[[SparkSession, str], DataFrame]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cs.read_lines(spark, fixtures.landed_lines(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    return cs.valid(cs.parse_log(_lines(spark, sf_dir), fields))


def _kafka(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cs.envelope(spark.read.parquet(fixtures.landed_kafka(spark, sf_dir)))


# Batch reports


def raw_pv(spark, sf_dir):
    return cs.pv_uv_raw(_lines(spark, sf_dir))


def visits(spark, sf_dir):
    return cs.visits(_lines(spark, sf_dir))


def visits_traffic(spark, sf_dir):
    return cs.pv_uv_raw_of(cs.visits(_lines(spark, sf_dir)))


def visits_areas(spark, sf_dir):
    return cs.areas_of(cs.visits(_lines(spark, sf_dir)))


def pv_uv(spark, sf_dir):
    return cs.pv_uv(_records(spark, sf_dir, "openid"))


def traffic_report(spark, sf_dir):
    log = cs.read_json(spark, fixtures.landed_lines(spark, sf_dir))
    report = cs.traffic_report(log, report_time=AS_OF)
    return report.withColumn("report_time", F.col("report_time").cast("string"))


def malformed_lines(spark, sf_dir):
    bad = cs.malformed(cs.parse_log(_lines(spark, sf_dir), fields=()))
    return bad.groupBy("kind").agg(F.count(F.lit(1)).alias("lines"))


def records(spark, sf_dir):
    log = cs.valid(cs.parse_log(_lines(spark, sf_dir)))
    return log.withColumn("event_time", F.col("event_time").cast("string"))


def identified_json(spark, sf_dir):
    log = cs.identified(cs.read_json(spark, fixtures.landed_lines(spark, sf_dir)))
    return log.withColumn("event_time", F.col("event_time").cast("string"))


def area_distribution(spark, sf_dir):
    return cs.area_distribution(_records(spark, sf_dir, "openid", "province", "city"))


def area_by_place(spark, sf_dir):
    log = _records(spark, sf_dir, "openid", "province", "city")
    return cs.area_distribution(log, by=("province", "city"))


def visitor_provinces(spark, sf_dir):
    return cs.visitor_provinces(_records(spark, sf_dir, "openid", "province"))


def first_visitor_provinces(spark, sf_dir):
    path = fixtures.landed_lines(spark, sf_dir)
    return cs.sql_report(spark, path, limit=10)["visitor_provinces"]


def sql_report_provinces(spark, sf_dir):
    return cs.sql_report(spark, fixtures.landed_lines(spark, sf_dir))["visitor_provinces"]


def _line_report(part: str, **options) -> Query:
    def query(spark, sf_dir):
        return cs.line_report(spark, fixtures.landed_lines(spark, sf_dir), **options)[part]

    return query


def _kinds(query: Query) -> Query:
    def counted(spark, sf_dir):
        return query(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("lines"))

    return counted


def labelled_records(spark, sf_dir):
    log = _records(spark, sf_dir, "cid", "pid", "total_money")
    return cs.with_category(log).select("cid", "category", "pid", "total_money")


def category_product_views(spark, sf_dir):
    return cs.category_product_views(
        _records(spark, sf_dir, "openid", "event_type", "cid", "pid")
    )


def top_products(spark, sf_dir):
    return cs.top_products(_records(spark, sf_dir, "openid", "event_type", "cid", "pid"))


def top_products_many(spark, sf_dir):
    log = _records(spark, sf_dir, "openid", "event_type", "cid", "pid")
    return cs.top_products(log, n=2000)


def total_sales(spark, sf_dir):
    return cs.total_sales(_records(spark, sf_dir, "total_money"))


def sales_today(spark, sf_dir):
    return cs.sales_today(_records(spark, sf_dir, "time", "total_money"), AS_OF)


def sales_by_day(spark, sf_dir):
    return cs.sales_by_day(_records(spark, sf_dir, "time", "total_money"))


def sales_by_category(spark, sf_dir):
    return cs.sales_by_category(_records(spark, sf_dir, "cid", "total_money"))


def sales_by_province(spark, sf_dir):
    return cs.sales_by_province(_records(spark, sf_dir, "province", "total_money"))


def sales_kpis(spark, sf_dir):
    return cs.kpi_values(_records(spark, sf_dir, "time", "cid", "province", "total_money"))


def range_filter(spark, sf_dir):
    log = _records(spark, sf_dir, "time", "page", "openid", "total_money")
    return cs.between_times(log, *RANGE).select("time", "page", "openid", "total_money")


# Kafka envelope and text


def kafka_values(spark, sf_dir):
    return _kafka(spark, sf_dir).select("partition", "offset", "value")


def offset_ranges(spark, sf_dir):
    return cs.offset_ranges(_kafka(spark, sf_dir))


def starting_offsets(spark, sf_dir):
    ranges = cs.offset_ranges(_kafka(spark, sf_dir))
    return cs.starting_offsets_json(ranges.withColumnRenamed("until_offset", "offset"))


def dedup_replay(spark, sf_dir):
    log = _kafka(spark, sf_dir)
    return cs.dedup_offsets(log.union(log)).select("topic", "partition", "offset", "value")


def stream_drop_replayed(spark, sf_dir):
    """The log, and all of it again ten days later."""
    work = scratch_dir(spark, "replays")
    records = cs.envelope(fixtures.replayed_stream(spark, sf_dir)).drop("key")
    query = (
        cs.drop_replayed(records)
        .writeStream.format("parquet")
        .option("path", f"{work}/records")
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{work}/records").select("topic", "partition", "offset", "value")


def recode_lines(spark, sf_dir):
    log = fixtures.log_from_events(spark, sf_dir).select("event_id", "cid", "city")
    labelled = cs.with_category(log, cs.category_dim(spark, "zh"))
    text = F.concat_ws(" ", "category", "city")
    garbled = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return cs.recode(labelled.select("event_id", garbled.alias("value")))


def recode_lines_gbk(spark, sf_dir):
    log = fixtures.log_from_events(spark, sf_dir).select("event_id", "cid", "city")
    # The few labels are made as a reader of the wrong charset would see them.
    labels = [
        (row.cid, row.category.encode("gbk").decode("latin-1"))
        for row in cs.category_dim(spark, "zh").collect()
    ]
    labelled = cs.with_category(log, spark.createDataFrame(labels, "cid string, category string"))
    text = F.concat_ws(" ", "category", "city")
    return cs.recode(labelled.select("event_id", text.alias("value")), "GBK")


# Streams


def _stream_kpi(kpi: str, column: str | None = None, to: str = "string") -> Query:
    def query(spark, sf_dir):
        stream = cs.stream_lines(spark, fixtures.landed_lines(spark, sf_dir))
        values = _kpi_table(spark, stream, kpis=(kpi,))
        key = [F.col("key").cast(to).alias(column)] if column else []
        return values.select(*key, F.col("value").alias("total_money"))

    return query


def _kpi_table(spark, stream, **options):
    work = scratch_dir(spark, "kpis")
    table = f"{work}/table"
    cs.run_kpis(stream, table, f"{work}/checkpoint", trigger=NOW, **options).awaitTermination()
    return cs.latest_kpis(spark, table)


def stream_sales_by_brand(spark, sf_dir):
    dim = fixtures.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("cid"), F.col("p_brand").alias("category")
    )
    work = scratch_dir(spark, "kpis")
    stream = cs.stream_lines(spark, fixtures.landed_lines(spark, sf_dir))
    cs.run_kpis(
        stream, f"{work}/table", f"{work}/checkpoint", kpis=("category",), trigger=NOW
    ).awaitTermination()
    values = cs.latest_kpis(spark, f"{work}/table", dim=dim)
    return values.select(F.col("key").alias("brand"), F.col("value").alias("total_money"))


def stream_kpis(spark, sf_dir):
    return _kpi_table(spark, cs.envelope(fixtures.landed_stream(spark, sf_dir)))


def _counted(spark, sf_dir, run, **options):
    work = scratch_dir(spark, "visitors")
    stream = cs.envelope(fixtures.landed_stream(spark, sf_dir))
    run(stream, f"{work}/table", f"{work}/checkpoint", trigger=NOW, **options).awaitTermination()
    return cs.latest_kpis(spark, f"{work}/table").withColumn("value", F.col("value").cast("bigint"))


def stream_uv(spark, sf_dir):
    views = _counted(spark, sf_dir, cs.run_views).select(F.col("value").alias("pv"), "key")
    visitors = _counted(spark, sf_dir, cs.run_visitors).select(F.col("value").alias("uv"), "key")
    return views.join(visitors, "key").select("pv", "uv")


def stream_uv_by_day(spark, sf_dir):
    """With the state of a day kept until all of the log has come."""
    counts = _counted(spark, sf_dir, cs.run_visitors, by_day=True, keep_days=40)
    return counts.select(F.col("key").cast("date").alias("dt"), F.col("value").alias("uv"))


def stream_top_products(spark, sf_dir):
    work = scratch_dir(spark, "rankings")
    stream = cs.envelope(fixtures.landed_stream(spark, sf_dir))
    cs.run_top_products(
        stream, f"{work}/table", f"{work}/checkpoint", trigger=NOW
    ).awaitTermination()
    return cs.batch_table(spark, f"{work}/table").drop("batch_id")


def _archive(spark, sf_dir, **options):
    work = scratch_dir(spark, "archive")
    stream = fixtures.landed_stream(spark, sf_dir).select(F.col("value").cast("string"))
    log = cs.valid(cs.parse_log(stream))
    cs.archive(
        log, f"{work}/log", f"{work}/checkpoint", trigger=NOW, **options
    ).awaitTermination()
    return spark.read.parquet(f"{work}/log")


def stream_archive(spark, sf_dir):
    archived = _archive(spark, sf_dir)
    return archived.withColumn("event_time", F.col("event_time").cast("string"))


def archive_sales_today(spark, sf_dir):
    return cs.sales_today(_archive(spark, sf_dir, files_per_day=1), AS_OF)


def _tail(spark, path: str, work: str) -> None:
    """Reads what is new in the files, as a run of its own."""
    lines = spark.readStream.format("tail_log").option("path", path).load().select("value")
    query = (
        lines.writeStream.format("parquet")
        .option("path", f"{work}/lines")
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()


def stream_tail(spark, sf_dir):
    cs.register_tail(spark)
    work = scratch_dir(spark, "tail")
    _tail(spark, fixtures.landed_lines(spark, sf_dir), work)
    return spark.read.parquet(f"{work}/lines")


def stream_tail_rotated(spark, sf_dir):
    """A log that is renamed with unread lines, and has grown past the old position when the
    source is started again."""
    cs.register_tail(spark)
    work = scratch_dir(spark, "tail")
    log = fixtures.GrowingLog(fixtures.landed_lines(spark, sf_dir), f"{work}/logs")
    log.append(0, 1 / 4)
    _tail(spark, log.path, work)
    log.append(1 / 4, 1 / 3)
    log.rotate()
    log.append(1 / 3, 1)
    _tail(spark, log.path, work)
    return spark.read.parquet(f"{work}/lines")


def stream_tail_capped(spark, sf_dir):
    """A backlog that is read a fifth at a time, by a run that is stopped and one that goes on."""
    cs.register_tail(spark)
    work = scratch_dir(spark, "tail")
    log = fixtures.GrowingLog(fixtures.landed_lines(spark, sf_dir), f"{work}/logs")
    log.append(0, 1)
    cap = log.size() // 5 + 1
    for _ in range(2):
        reader = spark.readStream.format("tail_log").option("path", log.path)
        options = {"maxBytesPerTrigger": cap, "positions": f"{log.folder}/_positions"}
        lines = reader.options(**options).load().select("value")
        writer = lines.writeStream.format("parquet").option("path", f"{work}/lines")
        query = writer.option("checkpointLocation", f"{work}/checkpoint").start()
        query.processAllAvailable()
        query.stop()
        log.append(0, 1)
    lines = spark.read.parquet(f"{work}/lines")
    if len(lines.inputFiles()) < 10:  # a file or more of each batch
        raise ValueError("the backlog was not read in parts")
    return lines


def _batch_steps(spark, sf_dir) -> str:
    work = scratch_dir(spark, "batches")
    cs.run_batches(
        cs.envelope(fixtures.landed_stream(spark, sf_dir)),
        f"{work}/checkpoint",
        cs.record_offsets(f"{work}/offsets"),
        cs.quarantine(f"{work}/malformed"),
        trigger=NOW,
    ).awaitTermination()
    return work


def stream_offset_ranges(spark, sf_dir):
    ledger = cs.batch_table(spark, f"{_batch_steps(spark, sf_dir)}/offsets")
    return ledger.groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset")
    )


def stream_quarantine(spark, sf_dir):
    kept = cs.batch_table(spark, f"{_batch_steps(spark, sf_dir)}/malformed")
    return kept.select("partition", "offset", "value", "kind")


# The streaming job as a whole

_jobs: dict[tuple[str, str], str] = {}


def _job(spark, sf_dir) -> str:
    """Folder with all that the job leaves, run once per session and folder of tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _jobs:
        work = scratch_dir(spark, "job")
        cs.run_job(
            cs.envelope(fixtures.landed_stream(spark, sf_dir)),
            f"{work}/kpis",
            f"{work}/checkpoint",
            offsets_path=f"{work}/offsets",
            malformed_path=f"{work}/malformed",
            raw_path=f"{work}/raw",
            compact_every=2,
            trigger=NOW,
        ).awaitTermination()
        _jobs[key] = work
    return _jobs[key]


def job_kpis(spark, sf_dir):
    return cs.latest_kpis(spark, f"{_job(spark, sf_dir)}/kpis")


def job_offsets(spark, sf_dir):
    ledger = cs.batch_table(spark, f"{_job(spark, sf_dir)}/offsets")
    return ledger.groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset")
    )


def job_malformed(spark, sf_dir):
    kept = cs.batch_table(spark, f"{_job(spark, sf_dir)}/malformed")
    return kept.select("partition", "offset", "value", "kind")


def job_archive(spark, sf_dir):
    archived = cs.batch_table(spark, f"{_job(spark, sf_dir)}/raw")
    archived = archived.drop("batch_id", "topic", "partition", "offset")
    return archived.withColumn("event_time", F.col("event_time").cast("string"))


def _started_job(spark, work: str, checkpoint: str, stream, **options):
    return cs.run_job(
        cs.envelope(stream),
        f"{work}/kpis",
        checkpoint,
        offsets_path=f"{work}/offsets",
        malformed_path=f"{work}/malformed",
        raw_path=f"{work}/raw",
        compact_every=2,
        trigger=NOW,
        **options,
    )


def _grown_job(spark, sf_dir, every: int = 0, shares=(0.3, 0.6, 1.0), after=None) -> str:
    """The job on a log that grows between its runs, with a partition that has no records."""
    work = scratch_dir(spark, "job")
    for share in shares:
        ends = fixtures.log_ends(spark, sf_dir, share)
        ends["access"]["3"] = 0
        stream = fixtures.partitioned_log(spark, sf_dir, f"{work}/checkpoint", ends, every=every)
        _started_job(spark, work, f"{work}/checkpoint", stream).awaitTermination()
        if after is not None:
            after(work)
    return work


def _history(spark, sf_dir):
    """Counts per day, refreshed after each run of the job; the archive is merged in between."""

    def refresh(work):
        cs.refresh_visits(spark, f"{work}/raw", f"{work}/visits", files_per_day=2)
        cs.compact_table(spark, f"{work}/raw")

    work = _grown_job(spark, sf_dir, after=refresh)
    return cs.daily_visits(spark, f"{work}/visits")


def history_areas(spark, sf_dir):
    return cs.areas_of_days(_history(spark, sf_dir))


def history_pv_uv(spark, sf_dir):
    return cs.traffic_of_days(_history(spark, sf_dir))


def history_traffic_by_day(spark, sf_dir):
    report = cs.traffic_by_day(_history(spark, sf_dir))
    return report.withColumn("dt", F.col("dt").cast("string"))


def job_planned_offsets(spark, sf_dir):
    """Every seventh offset is gone from the log, the last ones too, and a partition is empty."""
    ledger = cs.batch_table(spark, f"{_grown_job(spark, sf_dir, every=7)}/offsets")
    gaps = ledger.alias("a").join(
        ledger.alias("b"),
        F.expr("a.partition = b.partition AND a.batch_id = b.batch_id - 1 AND a.until_offset <> b.from_offset"),
        "left_semi",
    )
    return ledger.groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"),
        F.max("until_offset").alias("until_offset"),
        F.count(F.lit(1)).alias("batches"),
    ).withColumn("gaps", F.lit(gaps.count()))


def _handed_over_job(spark, sf_dir) -> str:
    """The job loses its checkpoint twice, and goes on from the recorded offsets each time."""
    work = scratch_dir(spark, "job")
    starts = None
    for run, share in enumerate((0.25, 0.5, 0.8, 1.0)):
        checkpoint = f"{work}/checkpoint{(run + 1) // 2}"  # the second run goes on, as the third does
        ends = fixtures.log_ends(spark, sf_dir, share)
        stream = fixtures.partitioned_log(spark, sf_dir, checkpoint, ends, starts)
        _started_job(spark, work, checkpoint, stream, take_over=run > 0).awaitTermination()
        ledger = cs.next_offsets(cs.batch_table(spark, f"{work}/offsets"))
        starts = json.loads(cs.starting_offsets_json(ledger).first().starting_offsets)
    return work


def job_handed_over_kpis(spark, sf_dir):
    return cs.latest_kpis(spark, f"{_handed_over_job(spark, sf_dir)}/kpis")


def job_handed_over_archive(spark, sf_dir):
    archived = cs.batch_table(spark, f"{_handed_over_job(spark, sf_dir)}/raw")
    return archived.drop("batch_id", "topic", "partition", "offset").withColumn(
        "event_time", F.col("event_time").cast("string")
    )


def job_compacted_archive(spark, sf_dir):
    """The archive of a job whose small folders were merged between its runs."""
    work = scratch_dir(spark, "job")
    for share in (0.2, 0.4, 0.6, 0.8, 1.0):
        ends = fixtures.log_ends(spark, sf_dir, share)
        stream = fixtures.partitioned_log(spark, sf_dir, f"{work}/checkpoint", ends)
        _started_job(spark, work, f"{work}/checkpoint", stream).awaitTermination()
        cs.compact_table(spark, f"{work}/raw")
    archived = cs.batch_table(spark, f"{work}/raw")
    return archived.drop("batch_id", "topic", "partition", "offset").withColumn(
        "event_time", F.col("event_time").cast("string")
    )


QUERIES: dict[str, Query] = {
    "raw_pv": raw_pv,
    "visits": visits,
    "visits_traffic": visits_traffic,
    "visits_areas": visits_areas,
    "pv_uv": pv_uv,
    "traffic_report": traffic_report,
    "malformed_lines": malformed_lines,
    "records": records,
    "identified_json": identified_json,
    "area_distribution": area_distribution,
    "area_by_place": area_by_place,
    "visitor_provinces": visitor_provinces,
    "first_visitor_provinces": first_visitor_provinces,
    "sql_report_provinces": sql_report_provinces,
    "line_report_traffic": _line_report("traffic"),
    "line_report_shared_traffic": _line_report("traffic", share=True),
    "line_report_shared_areas": _line_report("areas", share=True),
    "line_report_malformed": _kinds(_line_report("malformed")),
    "labelled_records": labelled_records,
    "category_product_views": category_product_views,
    "top_products": top_products,
    "top_products_many": top_products_many,
    "total_sales": total_sales,
    "sales_today": sales_today,
    "sales_by_day": sales_by_day,
    "sales_by_category": sales_by_category,
    "sales_by_province": sales_by_province,
    "sales_kpis": sales_kpis,
    "range_filter": range_filter,
    "kafka_values": kafka_values,
    "offset_ranges": offset_ranges,
    "starting_offsets": starting_offsets,
    "dedup_replay": dedup_replay,
    "recode_lines": recode_lines,
    "recode_lines_gbk": recode_lines_gbk,
    "stream_drop_replayed": stream_drop_replayed,
    "stream_total_sales": _stream_kpi("total"),
    "stream_sales_by_day": _stream_kpi("day", "dt", "date"),
    "stream_sales_by_category": _stream_kpi("category", "category"),
    "stream_sales_by_province": _stream_kpi("province", "province"),
    "stream_sales_by_brand": stream_sales_by_brand,
    "stream_kpis": stream_kpis,
    "stream_uv": stream_uv,
    "stream_uv_by_day": stream_uv_by_day,
    "stream_top_products": stream_top_products,
    "stream_archive": stream_archive,
    "archive_sales_today": archive_sales_today,
    "stream_tail": stream_tail,
    "stream_tail_rotated": stream_tail_rotated,
    "stream_tail_capped": stream_tail_capped,
    "stream_offset_ranges": stream_offset_ranges,
    "stream_quarantine": stream_quarantine,
    "job_kpis": job_kpis,
    "job_offsets": job_offsets,
    "job_malformed": job_malformed,
    "job_archive": job_archive,
    "job_planned_offsets": job_planned_offsets,
    "job_handed_over_kpis": job_handed_over_kpis,
    "job_handed_over_archive": job_handed_over_archive,
    "job_compacted_archive": job_compacted_archive,
    "history_areas": history_areas,
    "history_pv_uv": history_pv_uv,
    "history_traffic_by_day": history_traffic_by_day,
}
