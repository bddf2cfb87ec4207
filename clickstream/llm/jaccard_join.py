"""N-gram Jaccard join by MinHash LSH in fixed bands, with exact verification.

1. Every document has a set of word shingles and a MinHash signature. Documents of equal sets are
   folded to one representative.
2. Fixed bands replace an LSH forest. Each tree has one band, a prefix of some MinHashes, and the
   documents that share it are a branch. The lengths are computed beforehand, so that a pair at the
   threshold is found with the target recall; no trie is sorted and no prefix shortened by the data.
3. Branches of the same members count once. The members of a branch are linked if their whole
   signatures agree well enough; a large branch is compared in blocks.
4. Linked documents form candidate groups. Their shingle sets are shipped once, and all pairs of a
   group are verified in blocks, so that a group of any size is spread over many tasks. What
   leaves a block are counts and a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickstream.llm.common import (
    materialise,
    partitions,
    row_key,
    rows_without,
    ship,
    text_of,
)
from clickstream.llm.components import components
from clickstream.llm.hashing import blocks, byte_sums, mix, run_hashes, run_sums, words

SHINGLE = 5  # words
THRESHOLD = 0.8
TREES = 20
LONGEST = 8  # MinHashes of a label
RECALL = 0.9995  # of pairs at the threshold
SLACK = 0.3  # candidates may look this much less similar by their signatures
CELL = 512  # documents per side of a block of pairs


def prefix_lengths(
    threshold: float = THRESHOLD, trees: int = TREES, longest: int = LONGEST, recall: float = RECALL
) -> list[int]:
    """How long a shared prefix has to be in each tree.

    All start at the longest; one tree after the other is shortened by a MinHash until a pair at
    the threshold shares a prefix somewhere with probability `recall`.
    """
    lengths = [longest] * trees
    tree = 0
    while 1 - np.prod([1 - threshold**length for length in lengths]) < recall:
        if lengths == [1] * trees:
            raise ValueError("more trees are needed for this recall")
        lengths[tree] -= 1
        tree = (tree + 1) % trees
    return lengths


def _seeds(count: int) -> np.ndarray:
    return np.random.default_rng(11).integers(0, 1 << 64, count, np.uint64) | np.uint64(1)


def _shingles(texts: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts, sorted within each, and where each text's begin.

    A text of fewer words has one shingle of all of them, one without words has none.
    """
    ends = np.cumsum([0] + [len(text) for text in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    starts, stops = words(data, ends[:-1])
    sums = run_sums(run_hashes(byte_sums(data), starts, stops))
    at = np.searchsorted(starts, ends)
    count = np.diff(at)
    number = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(len(texts)), number)
    first = at[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    hashes = run_hashes(sums, first, np.minimum(first + shingle, at[1:][text]))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.searchsorted(text[new], np.arange(len(texts) + 1))


def _signed(lengths: list[int], shingle: int):
    """Signatures of documents: `lengths` says how many MinHashes each tree's prefix has."""
    seeds = _seeds(sum(lengths))
    cuts = np.cumsum([0, *lengths])

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, at = _shingles([t.encode() for t in batch.column("text").to_pylist()], shingle)
        number = np.diff(at)
        has = np.flatnonzero(number)
        begins = at[:-1][has]
        minima = np.empty((len(has), len(seeds)), np.uint64)
        sets = np.zeros((2, len(number)), np.uint64)
        if len(has):
            for k, seed in enumerate(seeds):
                minima[:, k] = np.minimum.reduceat(hashes * seed, begins)
            for k in range(2):
                salted = mix(hashes ^ np.uint64(0x5BD1E995 + k))
                sets[k, has] = np.add.reduceat(salted, begins)
        prefixes = np.empty((len(has), len(lengths)), np.uint64)
        for tree, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            label = np.full(len(has), tree, np.uint64)
            for k in range(a, b):
                label = mix(label * np.uint64(0x9E3779B97F4A7C15) ^ minima[:, k])
            prefixes[:, tree] = label
        signature = mix(minima).astype(np.uint8)
        rows = iter(range(len(has)))
        place = [next(rows) if n else None for n in number.tolist()]
        return pa.RecordBatch.from_pydict(
            {
                "doc": batch.column("doc"),
                "row": batch.column("row"),
                "n": pa.array(number, pa.int32()),
                "set1": pa.array(sets[0].view(np.int64)),
                "set2": pa.array(sets[1].view(np.int64)),
                "prefixes": pa.array(
                    [None if p is None else prefixes[p].view(np.int64) for p in place],
                    pa.list_(pa.int64()),
                ),
                "signature": pa.array(
                    [None if p is None else signature[p].tobytes() for p in place], pa.binary()
                ),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in blocks(batch.column("size").to_numpy()):
                yield sign(batch.slice(first, last - first))

    return run


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc"), row_key().alias("row"),
        text_of().alias("text"), F.octet_length(text_of()).alias("size"),
    )


def _sides(rows: DataFrame, size: str) -> DataFrame:
    """Deals the members of each group (`group`, `rep`) to blocks of pairs: `side` and `cell`.

    A group has as many sides as it needs, and a block has the members of one or two of them.
    """
    sides = F.ceil(F.col(size) / F.lit(CELL)).cast("int")
    dealt = rows.withColumn("sides", sides).withColumn(
        "side", F.pmod(F.xxhash64("rep"), F.col("sides")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("sides") - 1)).alias("other")
    return dealt.select("*", other).withColumn(
        "cell",
        F.xxhash64("group", F.least("side", "other"), F.greatest("side", "other")),
    ).drop("sides", "other")


def _in_buckets(cells: DataFrame) -> DataFrame:
    """Blocks by bucket, so that a task gets many small ones at once."""
    buckets = F.lit(8 * partitions(cells.sparkSession))
    return cells.withColumn("bucket", F.pmod("cell", buckets).cast("int"))


def _candidates(sets: DataFrame, least: float) -> DataFrame:
    """Links `a`, `b` between representatives that share a branch and have like signatures."""
    members = sets.select("rep", F.explode("prefixes").alias("branch"))
    branches = members.groupBy("branch").agg(
        F.count(F.lit(1)).alias("size"),
        F.bit_xor(F.xxhash64("rep")).alias("members"),
        F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("again"),
    )
    distinct = (
        branches.filter("size > 1")
        .groupBy("size", "members", "again")
        .agg(F.min("branch").alias("branch"))
        .select("branch", "size")
    )
    shared = members.join(materialise(distinct, "branches"), "branch")
    rows = shared.withColumnRenamed("branch", "group").join(sets.select("rep", "signature"), "rep")
    rep = sets.schema["rep"].dataType.simpleString()
    links = (
        _in_buckets(_sides(rows, "size"))
        .select("bucket", "cell", "side", "rep", "signature")
        .groupBy("bucket")
        .applyInArrow(_alike(least), f"a {rep}, b {rep}")
    )
    return materialise(links.distinct(), "candidates")


def _blocks_of(cell: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(cell, kind="stable")
    cuts = np.flatnonzero(cell[order][1:] != cell[order][:-1]) + 1
    return np.split(order, cuts)


def _whole(near: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The relation of two sides as one between all members; none is related to itself."""
    whole = np.zeros((size, size), bool)
    whole[np.ix_(a, b)] = near
    whole |= whole.T
    np.fill_diagonal(whole, False)
    return whole


def _two_sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = np.flatnonzero(side == side.min())
    return a, np.flatnonzero(side == side.max())


def _alike(least: float):
    """Links each member of a block to the first that it is connected to by like signatures.

    Of each MinHash 8 bits are compared.
    """

    def run(table: pa.Table) -> pa.Table:
        side, cell = (table.column(name).to_numpy() for name in ("side", "cell"))
        signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8)
        signatures = signatures.reshape(len(cell), -1)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        here = _blocks_of(cell) if len(cell) else []
        pairs = np.array([block for block in here if len(block) == 2], np.int64).reshape(-1, 2)
        like = (signatures[pairs[:, 0]] == signatures[pairs[:, 1]]).mean(axis=1) >= least
        found.append((pairs[like, 0], pairs[like, 1]))
        for block in here:
            if len(block) == 2:
                continue
            a, b = _two_sides(side[block])
            own, others = signatures[block[a]], signatures[block[b]]
            near = np.array([(others == one).mean(axis=1) >= least for one in own])
            root = _roots(_whole(near, a, b, len(block)))
            linked = np.flatnonzero(root != np.arange(len(block)))
            found.append((block[linked], block[root[linked]]))
        a, b = (np.concatenate(x) for x in zip(*found))
        reps = table.column("rep")
        return pa.table({"a": reps.take(pa.array(a)), "b": reps.take(pa.array(b))})

    return run


def _with_shingles(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in blocks(batch.column("size").to_numpy()):
                part = batch.slice(first, last - first)
                texts = [t.encode() for t in part.column("text").to_pylist()]
                hashes, at = _shingles(texts, shingle)
                sets = [hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
                names = ("rep", "group", "copies", "members")
                columns = {name: part.column(name) for name in names}
                yield pa.RecordBatch.from_pydict(columns | {"set": pa.array(sets, pa.binary())})

    return run


def _overlaps(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of `sets` shares with each of `others`."""
    common = np.zeros((len(sets), len(others)), np.float32)
    values, which = np.unique(np.concatenate([*sets, *others]), return_inverse=True)
    owner = np.repeat(np.arange(len(sets) + len(others)), [len(s) for s in (*sets, *others)])
    left = owner < len(sets)
    # Only what both sides have can be shared; it is counted some shingles at a time.
    shared = np.zeros(len(values), np.int8)
    shared[which[left]] = 1
    shared[which[~left]] |= 2
    kept = np.flatnonzero(shared == 3)
    column = np.full(len(values), -1, np.int64)
    column[kept] = np.arange(len(kept))
    column = column[which]
    order = np.argsort(column, kind="stable")
    order = order[np.searchsorted(column[order], 0) :]
    cuts = np.searchsorted(column[order], np.arange(0, len(kept) + 2048, 2048))
    for a, b in zip(cuts[:-1], cuts[1:]):
        here = order[a:b]
        has = np.zeros((len(sets) + len(others), 2048), np.float32)
        has[owner[here], column[here] % 2048] = 1
        common += has[: len(sets)] @ has[len(sets) :].T
    return common


def _near(sets: list[np.ndarray], others: list[np.ndarray], threshold: float) -> np.ndarray:
    common = _overlaps(sets, others)
    total = np.array([len(s) for s in sets])[:, None] + np.array([len(s) for s in others])[None, :]
    # The Jaccard similarity is common / (total - common).
    return common >= threshold * (total - common) - 1e-6


def _roots(near: np.ndarray) -> np.ndarray:
    """The smallest member of each one's group, `near` being symmetric."""
    label = np.arange(len(near))
    while True:
        lower = np.where(near, label[None, :], len(near)).min(axis=1)
        lower = np.minimum(label, lower)
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _verified(threshold: float):
    """Blocks of pairs: the links of each document there, and one link to its group's first."""

    def run(table: pa.Table) -> pa.Table:
        # A repeated row counts once.
        names = (table.column(name).to_pylist() for name in ("cell", "rep"))
        _, kept = np.unique([f"{c}/{m}" for c, m in zip(*names)], return_index=True)
        table = table.take(pa.array(kept))
        cell, copies, side = (table.column(n).to_numpy() for n in ("cell", "copies", "side"))
        sets = [np.frombuffer(s, np.uint64) for s in table.column("set").to_pylist()]
        links, first = np.zeros(len(cell), np.int64), np.arange(len(cell))
        for block in _blocks_of(cell) if len(cell) else []:
            a, b = _two_sides(side[block])
            near = _near([sets[i] for i in block[a]], [sets[i] for i in block[b]], threshold)
            whole = _whole(near, a, b, len(block))
            links[block] = whole @ copies[block]
            first[block] = block[_roots(whole)]
        return pa.table(
            {
                "a": table.column("rep"),
                "b": table.column("rep").take(pa.array(first)),
                "links": pa.array(links),
            }
        )

    return run


def _verify(docs: DataFrame, sets: DataFrame, groups: DataFrame, shingle: int, threshold: float):
    """Per block and representative: a link `a`, `b` within its group, and its number of links."""
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    dealt = (
        groups.join(materialise(sizes, "sizes"), "root")
        .join(sets.select(F.col("rep").alias("node"), "copies"), "node")
        .select(F.col("node").alias("rep"), F.col("root").alias("group"), "copies", "members",
                F.col("node.doc").alias("doc"), F.col("node.row").alias("row"))
    )
    # Rows that repeat id and text are one document here.
    texts = _documents(docs)
    same = texts["doc"].eqNullSafe(dealt["doc"]) & (texts["row"] == dealt["row"])
    rep = groups.schema["node"].dataType.simpleString()
    shipped = texts.join(dealt, same).select("rep", "group", "copies", "members", "text", "size")
    shipped = shipped.mapInArrow(
        _with_shingles(shingle), f"rep {rep}, group {rep}, copies long, members long, set binary"
    )
    return (
        _in_buckets(_sides(shipped, "members"))
        .select("bucket", "cell", "side", "rep", "copies", "set")
        .groupBy("bucket")
        .applyInArrow(_verified(threshold), f"a {rep}, b {rep}, links long")
    )


def jaccard_join(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    trees: int = TREES,
    recall: float = RECALL,
) -> DataFrame:
    """Every document with its links to documents of Jaccard similarity `threshold` or more.

    Per row: `doc_id`, `row` (see `row_key`), `class_id` (the smallest doc_id of the connected
    group), `copy_id` (the smallest doc_id of equal shingle sets) and `n_links` (how many other
    documents it is linked to, copies of the same set included). Words are runs without white
    space; a document of fewer than `shingle` words has one shingle of all of them. Documents
    without words have no links. A null doc_id comes before all others. Rows that repeat id and
    text are copies like any other. The forest may miss a pair, with a probability of 1 - `recall`
    for pairs at the threshold and less for nearer ones; no pair is linked that is not near.
    """
    ship(docs.sparkSession)
    lengths = prefix_lengths(threshold, trees, LONGEST, recall)
    signed = _documents(docs).mapInArrow(
        _signed(lengths, shingle),
        "doc long, row long, n int, set1 long, set2 long, prefixes array<long>, signature binary",
    )
    signed = materialise(signed, "signatures")
    keys = ["n", "set1", "set2"]
    filled = signed.filter("n > 0")
    first = F.min(F.struct(F.struct("doc", "row").alias("rep"), "prefixes", "signature"))
    sets = filled.groupBy(*keys).agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
    sets = materialise(sets.select(*keys, "first.*", "copies"), "sets")
    groups = components(_candidates(sets, threshold - SLACK))
    found = materialise(_verify(docs, sets, groups, shingle, threshold), "verified")
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b"))
    of_set = (
        sets.select(*keys, "rep", "copies")
        .join(links, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            *keys,
            F.col("rep.doc").alias("copy_id"),
            F.coalesce(F.col("root.doc"), F.col("rep.doc")).alias("class_id"),
            F.coalesce(F.col("root"), F.col("rep")).alias("root"),
            (F.coalesce(F.col("links"), F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    of_set = materialise(of_set, "classes")
    alone = signed.filter("n = 0").select(
        F.col("doc").alias("doc_id"), "row", F.col("doc").alias("class_id"),
        F.col("doc").alias("copy_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(True).alias("stays"),
    )
    linked = filled.join(of_set, keys).select(
        F.col("doc").alias("doc_id"), "row", "class_id", "copy_id", "n_links",
        (F.struct("doc", "row") == F.col("root")).alias("stays"),
    )
    return linked.unionByName(alone)


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The first document of every group of linked documents, with all its columns."""
    return rows_without(docs, jaccard_join(docs, **options).filter("NOT stays"))
