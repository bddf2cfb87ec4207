"""Packing of token sequences: best-two-fit over the histogram of lengths.

Documents are far too many for one packer, but there are only as many lengths as a sequence has
tokens. Spark counts the pieces of each length; the packer works on these counts alone and fills
many equal sequences in one step. Its plan says which ranks of a length go where, so each piece
finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from clickstream.llm.common import materialise, numbered, ship, text_of
from clickstream.llm.hashing import regrouped
from clickstream.llm.tokens import Table, encode, worker_table

CAPACITY = 2048
END = 0  # the id after each document
GROUP_BYTES = 8 << 20  # of text that a task encodes at a time


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = True
) -> DataFrame:
    """The pieces of each document: `doc_id`, `piece`, `start`, `length`, `ids_crc32` and `ids`.

    A document is the ids of its text and `END`; a null text is empty. Documents above the
    capacity are cut into full pieces, and the rest comes first. Without `ids` only their checksum
    (unsigned, over little-endian unsigned 32-bit ids) is returned. `tokenizer` is the path of a
    `tokenizers` file, the same on all executors. Repeated rows give repeated pieces.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if ids else []),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_table(tokenizer)
        for batch in regrouped(batches, GROUP_BYTES):
            yield _pieces(batch, tokenizer, capacity, ids, table)
            pa.default_memory_pool().release_unused()

    ship(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.select("*", F.octet_length("text").alias("size")).mapInArrow(cut, schema)


def _pieces(
    batch: pa.RecordBatch, tokenizer: str, capacity: int, with_ids: bool, table: Table
) -> pa.RecordBatch:
    rows, numbers, starts, lengths, sums, all_ids = [], [], [], [], [], []
    for row, ids in enumerate(encode(batch.column("text").to_pylist(), tokenizer, table)):
        ids = np.append(ids, np.uint32(END)).astype("<u4")
        rest = len(ids) % capacity
        cuts = ([0] if rest else []) + list(range(rest, len(ids), capacity))
        for number, start in enumerate(cuts):
            stop = cuts[number + 1] if number + 1 < len(cuts) else len(ids)
            rows.append(row)
            numbers.append(number)
            starts.append(start)
            lengths.append(stop - start)
            sums.append(zlib.crc32(ids[start:stop]))
            if with_ids:
                all_ids.append(ids[start:stop].view("<i4"))
    columns = {
        "doc_id": batch.column("doc_id").take(pa.array(rows, pa.int64())),
        "piece": pa.array(numbers, pa.int32()),
        "start": pa.array(starts, pa.int64()),
        "length": pa.array(lengths, pa.int64()),
        "ids_crc32": pa.array(sums, pa.int64()),
    }
    if with_ids:
        columns["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
    return pa.RecordBatch.from_pydict(columns)


def _fill(counts: np.ndarray, capacity: int) -> tuple[dict[int, int], int]:
    """The lengths of a greedily filled sequence, each time the longest that fits, and its gap."""
    taken: dict[int, int] = {}
    gap, below = capacity, capacity
    available = np.flatnonzero(counts)
    while gap:
        at = np.searchsorted(available, min(gap, below), side="right") - 1
        if at < 0:
            break
        length = int(available[at])
        taken[length] = min(int(counts[length]), gap // length)
        gap -= taken[length] * length
        below = length - 1
    return taken, gap


def _best_two(counts: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two lengths at hand with the largest sum within `room`."""
    available = np.flatnonzero(counts[:room])
    if not len(available):
        return None
    second = np.searchsorted(available, np.minimum(available, room - available), "right") - 1
    single = (second >= 0) & (available[second] == available) & (counts[available] < 2)
    second = second - single
    sums = np.where(second >= 0, available + available[second], 0)
    best = int(np.argmax(sums))
    return (int(available[best]), int(available[second[best]])) if sums[best] else None


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Sequences as (number of documents of each length, number of such sequences).

    A sequence is filled greedily. If a gap is left, its shortest document makes way for two
    others, if any two fit the wider gap more tightly. As many equal sequences are made as the
    counts allow, so the steps depend on the number of lengths, not on that of documents.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    plan = []
    while left.any():
        taken, gap = _fill(left, capacity)
        if gap:
            shortest = min(taken)
            for length, count in taken.items():
                left[length] -= count
            pair = _best_two(left, gap + shortest)
            for length, count in taken.items():
                left[length] += count
            if pair and sum(pair) > shortest:
                taken[shortest] -= 1
                for length in pair:
                    taken[length] = taken.get(length, 0) + 1
        taken = {length: count for length, count in taken.items() if count}
        times = min(int(left[length]) // count for length, count in taken.items())
        for length, count in taken.items():
            left[length] -= times * count
        plan.append((taken, times))
    return plan


def _places(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan by length and rank: from each rank on, the sequences and offsets that follow."""
    rows, used, sequence = [], {}, 0
    for taken, times in plan:
        offset = 0
        for length in sorted(taken, reverse=True):
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, offset, taken[length]))
            used[length] = rank + times * taken[length]
            offset += length * taken[length]
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "offset", "count"), table.T))


_RANKS = 1 << 48  # more than there are pieces of a length


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with their `sequence_id` and `offset` there.

    `pieces` has a `length` from 1 to the capacity, `doc_id` and `piece`; other columns stay. It
    is read several times and must give the same rows each time: materialise it first.
    """
    counts = {
        row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()
    }  # at most `capacity` rows
    places = _places(best_two_fit(counts, capacity))
    ranked = numbered(pieces, ["length"], ["doc_id", "piece"], "_rank")
    schema = T.StructType(
        [
            *pieces.schema.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    names = pieces.columns
    ship(pieces.sparkSession)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = places["length"] * _RANKS + places["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            at = np.searchsorted(keys, length * _RANKS + rank, side="right") - 1
            nth, within = np.divmod(rank - places["rank"][at], places["count"][at])
            found = {
                "sequence_id": pa.array(places["sequence"][at] + nth),
                "offset": pa.array(places["offset"][at] + within * length),
            }
            columns = {name: batch.column(name) for name in names} | found
            yield pa.RecordBatch.from_pydict(columns)

    return ranked.mapInArrow(place, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = True
) -> DataFrame:
    """The pieces of all documents, packed: see `token_pieces` and `pack`.

    With `ids`, the ids of a sequence are those of its pieces in the order of `offset`; they are
    joined back after packing, so that only lengths are moved for it.
    """
    pieces = materialise(token_pieces(docs, tokenizer, capacity, ids=False), "pieces")
    packed = pack(pieces, capacity)
    if not ids:
        return packed
    whole = token_pieces(docs, tokenizer, capacity).dropDuplicates(["doc_id", "piece", "ids_crc32"])
    whole = whole.select(F.col("doc_id").alias("_doc"), F.col("piece").alias("_piece"),
                         F.col("ids_crc32").alias("_crc"), "ids")
    same = (
        F.col("doc_id").eqNullSafe(F.col("_doc"))
        & (F.col("piece") == F.col("_piece"))
        & (F.col("ids_crc32") == F.col("_crc"))
    )
    return packed.join(whole, same).drop("_doc", "_piece", "_crc")
