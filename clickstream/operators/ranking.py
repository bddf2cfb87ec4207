"""Category labels and the most viewed products of each category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickstream.functions.parse import identified
from clickstream.schema import UNKNOWN_CATEGORY, VIEW, category_dim

# Tasks among which the products of one category are ranked first.
SHARES = 64


def _lookup(dim: DataFrame | None, spark) -> DataFrame:
    """One label per code. The fixed table is broadcast; of a caller's Spark knows the size."""
    if dim is None:
        return F.broadcast(category_dim(spark))
    return dim.groupBy("cid").agg(F.min("category").alias("category"))


def with_category(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Add `category`, the label of `cid`; a code without a label, or no code, is "unknown".

    `dim` has the columns `cid` and `category` and defaults to the fixed table.
    """
    labelled = df.join(_lookup(dim, df.sparkSession), "cid", "left")
    return labelled.withColumn("category", F.coalesce("category", F.lit(UNKNOWN_CATEGORY)))


def category_product_views(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Page views per category and product, over records with a visitor and a code.

    Views are summed per code before the labels are joined, so the join sees one row per
    product instead of one per view and a popular code cannot skew it.
    """
    views = (
        identified(df)
        .filter((F.col("event_type") == VIEW) & F.col("cid").isNotNull())
        .groupBy("cid", "pid")
        .agg(F.count(F.lit(1)).alias("views"))
    )
    return (
        with_category(views, dim).groupBy("category", "pid").agg(F.sum("views").alias("views"))
    )


def top_products(df: DataFrame, dim: DataFrame | None = None, n: int = 2) -> DataFrame:
    """The `n` most viewed products of each category, `rank` 1 first; `pid` breaks ties.

    How many products of a category have how many views tells the least number of views that can
    be among the first `n`. Only products that reach it are ranked, for any `n`: those above it
    are fewer than `n`, and of those that just reach it each share of the category's products
    passes on its own first `n`.
    """
    views = category_product_views(df, dim)
    more = Window.partitionBy("category").orderBy(F.col("views").desc())
    # One row per category and number of views: few, as there are few different numbers.
    cutoff = (
        views.groupBy("category", "views")
        .agg(F.count(F.lit(1)).alias("products"))
        .withColumn("above", F.sum("products").over(more) - F.col("products"))
        .filter(F.col("above") < n)
        .groupBy("category")
        .agg(F.min("views").alias("least"))
    )
    reached = views.join(cutoff, "category").filter(F.col("views") >= F.col("least"))
    return leading(reached, n)


def leading(views: DataFrame, n: int) -> DataFrame:
    """The first `n` rows of each category by `views` and `pid`, ranked in shares first."""
    order = [F.col("views").desc(), F.col("pid").asc_nulls_last()]
    share = F.pmod(F.xxhash64("pid"), F.lit(SHARES))
    first = _first(views.withColumn("share", share), ["category", "share"], order, n)
    ranked = _first(first.drop("share", "rank"), ["category"], order, n)
    return ranked.select("category", "pid", "views", F.col("rank").cast("bigint").alias("rank"))


def _first(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)
