"""Visits counted per day, kept beside an archive: reports over history without reading the log.

The counts of a day add up, so what a stream archives is counted once, when it is new, and added to
the days that it belongs to; lines that come late for an old day change that day and no other. Like
a batch table the counts have a commit log, which names a folder for each day and the last batch of
the archive that is counted in it. A refresh that is killed has changed nothing.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickstream.functions.parse import identified
from clickstream.storage import delete, names, size
from clickstream.streaming import commits as log
from clickstream.streaming.batches import BATCH, DATA, _FOLDER, _place, _read

KEYS = ["dt", "openid", "province", "city"]
SCHEMA = "openid string, province string, city string, views bigint, dt date"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def refresh_visits(
    spark: SparkSession, archive: str, path: str, files_per_day: int = 1
) -> list[date | None]:
    """Counts the records that the batch table `archive` got since the last call into the table at
    `path`; returns the days that changed, None for records without a time.

    Only the archive's new batches and the changed days of the table are read. A visitor with a
    third of the records is one row per task and place. `files_per_day` tasks write a day. It may
    run beside the stream and after any merge of the archive, one call at a time per table. If the
    archive was handed over to another checkpoint in between, which may take batches back, all is
    counted anew.
    """
    source, state = log.load(spark, archive), log.load(spark, path)
    _remove_remains(spark, path, state)
    mark = str(len(source.fenced))
    anew = state.owner not in (None, mark)
    seen = -1 if anew else state.last
    new = [folder for folder, (batch, _) in source.folders.items() if batch > seen]
    if not new and not anew:
        return []
    known = {} if anew else _folders_by_day(state)
    entry: dict = {"owner": mark, "add": {}, "deleted": [] if anew else list(state.replaced)}
    if anew:  # drops every folder, which the next refresh removes
        entry |= {"base": 0, "fenced": []}
    days: list[date | None] = []
    if new:
        rows = _read(spark, archive, new).filter(F.col("batch_id") > seen)
        rows = rows.withColumn("dt", F.col("dt").cast("date"))  # without any day it has no type
        days = [row["dt"] for row in rows.select("dt").distinct().collect()]  # one row a day
        counts = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("views"))
        before = [known[_name(day)] for day in days if _name(day) in known]
        if before:
            old = _days(spark, path, before).select(*KEYS, "views")
            counts = old.union(counts).groupBy(*KEYS).agg(F.sum("views").alias("views"))
        share = F.pmod(F.xxhash64("openid", "province", "city"), F.lit(files_per_day))
        folder = f"{BATCH}-{source.last}-{uuid.uuid4().hex}"
        place = _place(path, folder)
        counts.repartition("dt", share).write.partitionBy("dt").parquet(place)
        for name in names(spark, place):
            if name.startswith("dt="):
                day = f"{folder}/{name}"
                entry["add"][day] = (source.last, size(spark, _place(path, day)))
        entry["remove"] = before
    for old_folder in entry["deleted"]:
        delete(spark, _place(path, old_folder))
    start = state.next

    def decide(now: log.Commits) -> dict:
        if now.next != start:
            raise ValueError(f"{path} was refreshed by another process at the same time")
        return entry

    log.commit(spark, path, state, decide)
    return days


def daily_visits(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """`dt`, `openid`, `province`, `city` and `views` of the days from `first` to `last`.

    Without bounds also what has no day. Only folders of these days are looked at.
    """
    chosen = []
    for name, folder in _folders_by_day(log.load(spark, path)).items():
        day = None if name == _name(None) else date.fromisoformat(name.removeprefix("dt="))
        bounded = first is not None or last is not None
        if day is None and bounded:
            continue
        if (first is None or day >= first) and (last is None or day <= last):
            chosen.append(folder)
    return _days(spark, path, chosen).select(*KEYS, "views")


def traffic_by_day(daily: DataFrame) -> DataFrame:
    """`dt`, views (`pv`) and distinct visitors (`uv`) of known visitors, each day of `daily`."""
    known = F.col("openid").isNotNull()
    return daily.groupBy("dt").agg(
        F.coalesce(F.sum(F.when(known, F.col("views"))), F.lit(0).cast("bigint")).alias("pv"),
        F.countDistinct("openid").alias("uv"),
    )


def traffic_of_days(daily: DataFrame) -> DataFrame:
    """The row of `pv_uv` over all days of `daily`."""
    return identified(daily).agg(
        F.coalesce(F.sum("views"), F.lit(0).cast("bigint")).alias("pv"),
        F.countDistinct("openid").alias("uv"),
    )


def areas_of_days(daily: DataFrame) -> DataFrame:
    """The rows of `area_distribution` over all days of `daily`."""
    areas = identified(daily).groupBy("openid", "province", "city")
    return areas.agg(F.sum("views").alias("views"))


def _name(day: date | None) -> str:
    return f"dt={_NO_DAY if day is None else day.isoformat()}"


def _folders_by_day(state: log.Commits) -> dict[str, str]:
    return {folder.split("/")[1]: folder for folder in state.folders}


def _days(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], SCHEMA)
    paths = [_place(path, folder) for folder in sorted(folders)]
    return spark.read.schema(SCHEMA).option("basePath", f"{path}/{DATA}").parquet(*paths)


def _remove_remains(spark: SparkSession, path: str, state: log.Commits) -> None:
    """Removes folders that no commit names: of killed refreshes, and of counts made anew."""
    known = {folder.split("/")[0] for folder in (*state.folders, *state.replaced)}
    for name in names(spark, f"{path}/{DATA}"):
        if name.removeprefix(f"{_FOLDER}=") not in known:
            delete(spark, f"{path}/{DATA}/{name}")
