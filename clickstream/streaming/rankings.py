"""The most viewed products of each category, kept up to date on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickstream.functions.parse import identified, parse_log, valid
from clickstream.operators.ranking import leading, with_category
from clickstream.schema import VIEW
from clickstream.streaming import commits as log
from clickstream.streaming.batches import BATCH_INTERVAL, each_batch, replace_table
from clickstream.streaming.kpis import STATE_PARTITIONS, _shuffle_partitions


def new_leaders(changed: DataFrame, before: DataFrame | None, n: int) -> DataFrame:
    """The first `n` of each category, of those before and the products whose views changed.

    Views only grow, so a product that did not change and did not lead cannot lead now. Of the changed
    ones only those go on that reach the least of their category's `n` leaders, its cut-off; a
    category with fewer leaders has none.
    """
    views = changed.select("category", "pid", "views")
    if before is None:
        return leading(views, n)
    cutoff = (
        before.groupBy(F.col("category").alias("of"))
        .agg(F.min("views").alias("least"), F.count(F.lit(1)).alias("leaders"))
        .filter(F.col("leaders") >= n)
        .drop("leaders")
    )
    # At most one row per category, of which there are few.
    reach = views.join(F.broadcast(cutoff), F.col("category") == F.col("of"), "left")
    reach = reach.filter(F.col("least").isNull() | (F.col("views") >= F.col("least")))
    both = reach.select("category", "pid", "views").unionByName(before.select("category", "pid", "views"))
    return leading(both.groupBy("category", "pid").agg(F.max("views").alias("views")), n)


def run_top_products(
    lines: DataFrame,
    table: str,
    checkpoint: str,
    dim: DataFrame | None = None,
    n: int = 2,
    trigger: dict | None = None,
    state_partitions: int | None = STATE_PARTITIONS,
) -> StreamingQuery:
    """Start a query that keeps the `n` most viewed products of each category in the table.

    Read it with `batch_table`: `category`, `pid`, `views` and `rank`, as `top_products` gives them.
    The state has the views of each product, with map-side sums before the shuffle; a batch ranks
    only the products that it changed and that reach the cut-off (see `new_leaders`). A table
    belongs to one checkpoint.
    """
    spark = lines.sparkSession
    log.check_owner(spark, table, checkpoint)
    records = valid(parse_log(lines, ["openid", "event_type", "cid", "pid"]))
    seen = identified(records).filter((F.col("event_type") == VIEW) & F.col("cid").isNotNull())
    views = with_category(seen, dim).groupBy("category", "pid").agg(F.count(F.lit(1)).alias("views"))
    step = replace_table(table, lambda batch, before: new_leaders(batch, before, n))
    writer = (
        views.writeStream.outputMode("update")
        .foreachBatch(each_batch(step, skip_empty=False))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or BATCH_INTERVAL))
    )
    with _shuffle_partitions(spark, state_partitions):
        return writer.start()
