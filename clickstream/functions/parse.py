"""JSON lines to typed records, with malformed lines kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickstream.schema import CORRUPT, LOG_FIELDS, MONEY, TIME_PATTERN, log_schema

JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def typed(df: DataFrame) -> DataFrame:
    """Convert the text fields that carry numbers or times; a bad value becomes null.

    Adds `event_time` (timestamp) and `dt` (date) when `time` is present. A cast takes a third
    of the time of a conversion by format but also accepts times of other forms, hence the
    pattern before it.
    """
    conversions = {}
    if "event_type" in df.columns:
        conversions["event_type"] = F.col("event_type").try_cast("int")
    if "total_money" in df.columns:
        conversions["total_money"] = F.col("total_money").try_cast(MONEY)
    if "time" in df.columns:
        time = F.col("time")
        event_time = F.when(time.rlike(TIME_PATTERN), time.try_cast("timestamp"))
        conversions["event_time"] = event_time
        conversions["dt"] = F.to_date(event_time)
    return df.withColumns(conversions) if conversions else df


def parse_log(lines: DataFrame, fields=LOG_FIELDS) -> DataFrame:
    """Parse `lines.value`, one JSON object per line, batch or stream.

    The input columns stay. Added: the typed record, `_corrupt` (the text of a malformed
    line) and `ok` (the line holds a record). `fields` names what the caller needs of the
    record. Catalyst does not prune a `from_json` that has options, and skipping fields
    halves the parse time; a line is judged malformed or not all the same.

    The record goes through `explode` instead of a plain projection: a filter on a projected
    `from_json` is pushed below the projection and parses every line again, once per
    predicate. Nothing is pushed through a generator, so each line is parsed once.
    """
    record = F.from_json("value", log_schema(fields, corrupt=True), JSON_OPTIONS)
    parsed = lines.select("*", F.explode(F.array(record)).alias("_record"))
    ok = F.col("_record").isNotNull() & F.col(f"_record.{CORRUPT}").isNull()
    return typed(parsed.select(*lines.columns, "_record.*", ok.alias("ok")))


def malformed(parsed: DataFrame) -> DataFrame:
    """Lines that hold no record: `value`, `kind` ("blank" or "corrupt") and any envelope."""
    kind = F.when(F.col(CORRUPT).isNull(), "blank").otherwise("corrupt").alias("kind")
    derived = {*LOG_FIELDS, "event_time", "dt", CORRUPT, "ok"}
    return parsed.filter(~F.col("ok")).select(
        *[name for name in parsed.columns if name not in derived], kind
    )


def valid(parsed: DataFrame) -> DataFrame:
    """Records only, without the columns that served to judge the line."""
    return parsed.filter("ok").drop("value", CORRUPT, "ok")


def identified(df: DataFrame) -> DataFrame:
    """Records of known visitors. An empty `openid` is known; only null is not."""
    return df.filter(F.col("openid").isNotNull())
