"""The access-log record and the small fixed tables that belong to it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

# The fields of one log record, in record order.
LOG_FIELDS = (
    "time",
    "page",
    "openid",
    "event_type",
    "province",
    "city",
    "cid",
    "pid",
    "total_money",
)

# Event code of a page view, form of `time`, label of a foreign category code.
VIEW = 1
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
UNKNOWN_CATEGORY = "unknown"

# Category code, English label, Chinese label.
CATEGORIES = (
    ("1", "books", "图书"),
    ("2", "clothing", "服装"),
    ("3", "furniture", "家具"),
    ("4", "phones", "手机"),
)

# Column that receives the text of a line that is not a JSON object.
CORRUPT = "_corrupt"

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def log_schema(fields=LOG_FIELDS, corrupt: bool = False) -> T.StructType:
    """Schema of a record as it is read: every field a string.

    A numeric field declared as a number would turn `{"event_type":"1"}` into a malformed
    line, so numbers are read as text and converted by `typed`.
    """
    unknown = set(fields) - set(LOG_FIELDS)
    if unknown:
        raise ValueError(f"no fields of a log record: {sorted(unknown)}")
    names = [name for name in LOG_FIELDS if name in fields]
    if corrupt:
        names.append(CORRUPT)
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


LOG = log_schema()


def category_dim(spark: SparkSession, language: str = "en") -> DataFrame:
    """The fixed `(cid, category)` table; `language` is "en" or "zh"."""
    label = {"en": 1, "zh": 2}[language]
    rows = ", ".join(f"('{row[0]}', '{row[label]}')" for row in CATEGORIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(cid, category)")
