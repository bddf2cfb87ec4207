"""Sales totals, over all records or by day, category or province.

Every valid record counts unless `event_types` narrows it down. Amounts are decimals, so the
sums do not depend on the order of the rows; null amounts are ignored and no amount at all
gives null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickstream.functions.timerange import between_times, on_day_until
from clickstream.operators.ranking import with_category
from clickstream.schema import MONEY_SUM

# Key of the only row of the "total" indicator.
ALL = "all"


def _amount() -> Column:
    return F.sum("total_money").cast(MONEY_SUM).alias("total_money")


def of_types(df: DataFrame, event_types=None) -> DataFrame:
    """Records with one of the event codes; all records if none are given."""
    return df if event_types is None else df.filter(F.col("event_type").isin(list(event_types)))


def total_sales(df: DataFrame, event_types=None) -> DataFrame:
    return of_types(df, event_types).agg(_amount())


def sales_between(df: DataFrame, lo, hi, event_types=None, include_hi: bool = True) -> DataFrame:
    return total_sales(between_times(df, lo, hi, include_hi), event_types)


def sales_today(df: DataFrame, as_of, event_types=None) -> DataFrame:
    """Sales from the midnight before `as_of`, in the session's time zone, until `as_of`."""
    return total_sales(on_day_until(df, as_of), event_types)


def sales_by_day(df: DataFrame, event_types=None) -> DataFrame:
    return of_types(df, event_types).groupBy("dt").agg(_amount())


def sales_by_category(df: DataFrame, dim: DataFrame | None = None, event_types=None) -> DataFrame:
    """Sums per code first, then labels the few sums and adds up what shares a label."""
    by_code = of_types(df, event_types).groupBy("cid").agg(_amount())
    return with_category(by_code, dim).groupBy("category").agg(_amount())


def sales_by_province(df: DataFrame, event_types=None) -> DataFrame:
    return of_types(df, event_types).groupBy("province").agg(_amount())


# Indicators that `kpi_values` can compute, with the field of a record each needs.
KPIS = {"total": None, "day": "time", "category": "cid", "province": "province"}

# The column of a typed record that an indicator sums by.
_KEYS = {"day": "dt", "category": "cid", "province": "province"}


def kpi_values(
    df: DataFrame, kpis=tuple(KPIS), dim: DataFrame | None = None, event_types=None
) -> DataFrame:
    """All sales indicators in one pass: `(kpi, key, value)`, batch or stream.

    Sums are made by code and labelled at last, so that the labels are joined to few rows.
    """
    return labelled_kpis(code_kpis(df, kpis, event_types), dim)


def code_kpis(df: DataFrame, kpis=tuple(KPIS), event_types=None) -> DataFrame:
    """The indicators as `kpi_values`, but "category" with the codes as keys.

    The amounts become one short row per indicator, summed by (kpi, key). The map-side sums
    leave a task at most one row per key, so the shuffle and, on a stream, the state are as
    small as the result. In batch the amounts are first summed by all keys together, which
    leaves few rows to multiply; a stream allows only one aggregation.
    """
    rows = of_types(df, event_types)
    if not df.isStreaming:
        rows = rows.groupBy(*[_KEYS[kpi] for kpi in kpis if kpi in _KEYS]).agg(_amount())
    keys = {
        "total": F.lit(ALL),
        "day": F.col("dt").cast("string"),
        "category": F.col("cid"),
        "province": F.col("province"),
    }
    return (
        rows.select("total_money", *[keys[kpi].alias(kpi) for kpi in kpis])
        .unpivot("total_money", list(kpis), "kpi", "key")
        .groupBy("kpi", "key")
        .agg(_amount().alias("value"))
    )


def labelled_kpis(values: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Indicators by code with the labels of the codes: what shares a label is added up."""
    is_code = F.col("kpi") == "category"
    by_label = (
        with_category(values.filter(is_code).withColumnRenamed("key", "cid"), dim)
        .groupBy("kpi", F.col("category").alias("key"))
        .agg(F.sum("value").cast(MONEY_SUM).alias("value"))
    )
    return values.filter(~is_code).unionByName(by_label)
