"""Sharding by best-fit decreasing: indivisible groups of rows into bins of one capacity.

The groups are far too many for one task, but only large ones need to be placed one by one. Spark
sums the sizes of the groups, and joins those smaller than a `grain`-th of a shard to bundles of
about that size. What is left to place is at most some `grain` items per shard, whatever the
number of rows.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickstream.llm.common import materialise, numbered, text_of

GRAIN = 500  # a group this small a part of a shard is placed as part of a bundle
BUCKETS = 1024  # tasks that bundle at a time


class _Tree:
    """Bins in the order of (room, number): a search tree balanced by random priorities."""

    def __init__(self):
        self._root = None
        self._random = random.Random(0)

    def _split(self, node, key):
        """What is below `key`, and the rest."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return [node[0], node[1], node[2], low], high
        low, high = self._split(node[2], key)
        return low, [node[0], node[1], high, node[3]]

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            return [low[0], low[1], low[2], self._merge(low[3], high)]
        return [high[0], high[1], self._merge(low, high[2]), high[3]]

    def insert(self, key) -> None:
        low, high = self._split(self._root, key)
        node = [key, self._random.random(), None, None]
        self._root = self._merge(self._merge(low, node), high)

    def take_tightest(self, size):
        """Removes and returns the first (room, number) with at least this room, if any."""
        low, high = self._split(self._root, (size, -1))
        if high is None:
            return None
        first = high
        while first[2] is not None:
            first = first[2]
        _, rest = self._split(high, (first[0][0], first[0][1] + 1))
        self._root = self._merge(low, rest)
        return first[0]


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size; a size above the capacity has a bin of its own."""
    bins, tree, opened = [0] * len(sizes), _Tree(), 0
    for at in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take_tightest(sizes[at])
        if found is None:
            found, opened = (max(capacity, sizes[at]), opened), opened + 1
        bins[at] = found[1]
        tree.insert((found[0] - sizes[at], found[1]))
    return bins


def _smallest_capacity(sizes: list[int], shards: int) -> list[int]:
    """The bins for the smallest capacity found at which best fit needs no more than `shards`."""
    low = max([-(-sum(sizes) // shards), *sizes])
    slack, best = 0, best_fit_decreasing(sizes, low)
    while max(best, default=0) >= shards:
        slack = 2 * slack + 1
        best = best_fit_decreasing(sizes, low + slack)
    fails = slack // 2 if slack else 0
    while slack - fails > 1:
        middle = (slack + fails) // 2
        bins = best_fit_decreasing(sizes, low + middle)
        if max(bins) < shards:
            slack, best = middle, bins
        else:
            fails = middle
    return best


def _bundles(groups: DataFrame, unit: int) -> DataFrame:
    """`group`, `bytes` and the item it is placed with: itself, or a bundle of small groups."""
    bucket = F.pmod(F.xxhash64("group"), F.lit(BUCKETS))
    below = (
        Window.partitionBy("bucket")
        .orderBy(F.desc("bytes"), "group")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    small = groups.filter(F.col("bytes") < unit).withColumn("bucket", bucket)
    large = groups.filter(F.col("bytes") >= unit)
    part = F.floor(F.coalesce(F.sum("bytes").over(below), F.lit(0)) / F.lit(unit))
    return small.select(
        "group", "bytes", F.concat_ws("/", F.col("bucket"), part).alias("item")
    ).unionByName(large.select("group", "bytes", F.col("group").alias("item")))


def shards_of_groups(groups: DataFrame, shards: int = 8, grain: int = GRAIN) -> DataFrame:
    """`group` and `shard` (0 to `shards` - 1), the bytes of the shards being near equal.

    `groups` has one row per `group` (a string) with its `bytes`. The capacity of the shards is
    the smallest at which best fit needs no more than `shards` of them. A group larger than its
    share of all bytes fills a shard alone and keeps it from being equal to the others.
    """
    spark = groups.sparkSession
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    items = materialise(_bundles(groups, max(1, total // (shards * grain))), "bundles")
    # At most shards * grain large groups, and 2 * shards * grain + BUCKETS bundles.
    sizes = items.groupBy("item").agg(F.sum("bytes").alias("bytes")).orderBy("item").collect()
    bins = _smallest_capacity([row["bytes"] for row in sizes], shards)
    placed = spark.createDataFrame(
        [(row["item"], bin_) for row, bin_ in zip(sizes, bins)], "item string, shard int"
    )
    return items.join(F.broadcast(placed), "item").select("group", "shard")


def shard_rows(
    docs: DataFrame, group: Column, size: Column, columns: dict[str, Column], shards: int = 8
) -> DataFrame:
    """`columns`, `size`, `shard` and `slot` (from 0 without gaps in each shard) of every row.

    Rows of one `group` go to the same shard. The first of `columns` orders the rows of a shard
    as far as their numbers go; repeated rows have slots of their own.
    """
    keys = docs.select(
        *[column.alias(name) for name, column in columns.items()],
        size.cast("long").alias("size"),
        group.alias("group"),
    )
    keys = materialise(keys, "shard-keys")
    groups = keys.groupBy("group").agg(F.sum("size").alias("bytes"))
    placed = materialise(keys.join(shards_of_groups(groups, shards), "group"), "sharded")
    first = next(iter(columns))
    return numbered(placed, ["shard"], [first, "group"], "slot").drop("group")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Documents in shards of near equal bytes, equal texts together.

    The size of a document is that of its text in UTF-8, and 1 more; a null text counts as empty.
    Returns doc_id, size, text_crc32, law, shard, slot and grown_shard (null: adding a shard moves
    rows between all).
    """
    text = F.encode(text_of(), "UTF-8")
    rows = shard_rows(
        docs,
        group=F.sha2(text, 256),
        size=F.octet_length(text_of()) + 1,
        columns={"doc_id": F.col("doc_id"), "text_crc32": F.crc32(text)},
        shards=shards,
    )
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
