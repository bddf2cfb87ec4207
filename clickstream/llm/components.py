"""Connected components of a graph of any size, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickstream.llm.common import materialise

def components(links: DataFrame) -> DataFrame:
    """`node` and `root` (the smallest node of its component) of every node in `links`.

    `links` has the columns `a` and `b` of any one type that can be ordered; direction, repeated
    links and loops do not matter, links with a null do not count. In each round every node first
    hands its larger neighbours over to its smallest one (large star), then its smaller ones
    (small star); what is left in the end is a star around each root. Rounds grow with the
    logarithm of the longest path. Each is written to the shared folder; the driver sees two
    numbers of each.
    """
    larger = F.greatest("a", "b")
    edges = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        larger.alias("a"), F.least("a", "b").alias("b")
    )
    edges = materialise(edges.distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        edges = materialise(_handed_over(both).filter("b < a").distinct(), "large-star")
        edges = materialise(_small_star(edges), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def _handed_over(both: DataFrame) -> DataFrame:
    """Each node's larger neighbours, linked to the smallest of the node and its neighbours."""
    smallest = both.groupBy("a").agg(F.min("b").alias("to"))
    # Written so that Spark may split a hot node in the join.
    linked = both.filter("b > a").join(materialise(smallest, "smallest"), "a")
    return linked.select(F.col("b").alias("a"), F.least("a", "to").alias("b"))


def _small_star(down: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked to the smallest of these.

    A node has few smaller neighbours once they are handed over, so none is hot here.
    """
    smaller = F.sort_array(F.collect_set("b"))
    stars = down.groupBy("a").agg(smaller.alias("smaller"))
    nodes = F.explode(F.concat(F.array("a"), F.slice("smaller", 2, F.size("smaller"))))
    return stars.select(nodes.alias("a"), F.get("smaller", F.lit(0)).alias("b")).distinct()
