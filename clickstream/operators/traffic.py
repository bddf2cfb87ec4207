"""Page views, unique visitors and where visitors come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickstream.functions.parse import identified, parse_log

VIEW_NAME = "access_log"


def pv_uv_raw(lines: DataFrame) -> DataFrame:
    """One row over raw lines: `pv_raw`, `parsed`, `malformed`, `pv`, `uv`.

    `pv_raw` counts every line, blank and malformed ones too; `pv` and `uv` only those with a
    visitor. One scan and one parse serve all five. The distinct count shuffles by visitor
    after a map-side merge, so a visitor with a third of the lines costs one row per task.
    """
    parsed = parse_log(lines, fields=["openid"])
    openid = F.when(F.col("ok"), F.col("openid"))
    return parsed.agg(
        F.count(F.lit(1)).alias("pv_raw"),
        F.count_if("ok").alias("parsed"),
        F.count_if(~F.col("ok")).alias("malformed"),
        F.count(openid).alias("pv"),
        F.countDistinct(openid).alias("uv"),
    )


def visits(lines: DataFrame) -> DataFrame:
    """Lines counted as `views` per `ok`, visitor, province and city.

    Several reports come from this one pass over the log: `pv_uv_raw_of` gives the row of
    `pv_uv_raw`, `areas_of` that of `area_distribution`. Persist it to share the pass.
    """
    keys = ["openid", "province", "city"]
    return parse_log(lines, keys).groupBy("ok", *keys).agg(F.count(F.lit(1)).alias("views"))


def pv_uv_raw_of(visits: DataFrame) -> DataFrame:
    """The row of `pv_uv_raw` from counted lines."""
    known = F.col("ok") & F.col("openid").isNotNull()

    def views_if(condition) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("views"))), F.lit(0).cast("bigint"))

    return visits.agg(
        views_if(F.lit(True)).alias("pv_raw"),
        views_if(F.col("ok")).alias("parsed"),
        views_if(~F.col("ok")).alias("malformed"),
        views_if(known).alias("pv"),
        F.countDistinct(F.when(known, F.col("openid"))).alias("uv"),
    )


def areas_of(visits: DataFrame) -> DataFrame:
    """The rows of `area_distribution` from counted lines."""
    return identified(visits.filter("ok")).drop("ok")


def pv_uv(df: DataFrame) -> DataFrame:
    """One row: views (`pv`) and distinct visitors (`uv`) of identified records."""
    return identified(df).agg(
        F.count(F.lit(1)).alias("pv"), F.countDistinct("openid").alias("uv")
    )


def register_log(df: DataFrame, name: str = VIEW_NAME) -> DataFrame:
    """Make the log available to SQL under `name`, replacing an earlier view."""
    df.createOrReplaceTempView(name)
    return df


def traffic_report(df: DataFrame, report_time=None, view: str = VIEW_NAME) -> DataFrame:
    """`pv_uv` with the time of the report, as SQL over the registered view.

    `report_time` defaults to the current time; give one to get a reproducible row.
    """
    register_log(df, view)
    return df.sparkSession.sql(
        """
        SELECT coalesce(CAST(:report_time AS timestamp), current_timestamp()) AS report_time,
               count(*) AS pv,
               count(DISTINCT openid) AS uv
        FROM identifier(:view)
        WHERE openid IS NOT NULL
        """,
        args={"report_time": report_time, "view": view},
    )


def area_distribution(df: DataFrame, by=("openid", "province", "city")) -> DataFrame:
    """Views per visitor, province and city; `by=("province", "city")` counts per place."""
    return identified(df).groupBy(*by).agg(F.count(F.lit(1)).alias("views"))


def visitor_provinces(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct (visitor, province) pairs; a null province makes a pair too.

    With `limit`, the first pairs in order, so that the answer is the same on every run.
    """
    visit = F.struct("openid", "province").alias("visit")
    pairs = identified(df).select(visit).distinct().select("visit.openid", "visit.province")
    return pairs if limit is None else pairs.orderBy("openid", "province").limit(limit)
