"""How two tokenizers cut the same texts: aligned groups of tokens and linked ids.

A text, with a space before it, is cut by a byte-level tokenizer (A) and by a sentencepiece model
(B). Tokens are intervals of bytes. All intervals are sorted by their start; where a start reaches
the running maximum of the ends so far, both tokenizers have a boundary, and a group begins. Within
a group every A token is linked to every B token that it overlaps.

Both tokenizers cut before white space that follows something else, so no group reaches beyond a
word with the white space before it. Each different such segment is aligned once per task, and
a document's groups and links are those of its segments. The table of segments has a bounded size:
when it is full it starts anew.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickstream.llm.common import materialise, ship, text_of
from clickstream.llm.hashing import blocks, byte_sums, regrouped, run_hashes
from clickstream.llm.tokens import _segment_starts, ends_whole

TEXT_BYTES = 2 << 20  # of text that a task aligns at a time; a longer text is taken alone
TABLE_BYTES = 96 << 20  # that the different segments take which a task keeps
SEGMENT_BYTES = 250  # that each takes beside its text
JOINED = 512  # short segments that are encoded in one call
BROADCAST_PAIRS = 2_000_000  # linked pairs that are broadcast; more are joined by a shuffle

# The white space before which texts may be cut.
_BLANKS = "\t\n\v\f\r "
# Fixed value: as a second `normalizer_spec` of a model file it says `add_dummy_prefix: false`.
_NO_PREFIX = b"\x1a\x02\x18\x00"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class _ByteLevel:
    """A: a `tokenizers` file with a byte-level vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        byte, vocabulary = _byte_of(), self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, id_ in vocabulary.items():
            self.bytes[id_] = bytes(byte[c] for c in token if c in byte)
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        self.joining = ""

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class _Pieces:
    """B: a sentencepiece model, which is given its space instead of adding one."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as file:
            model = file.read() + _NO_PREFIX
        self.model = SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(id_) for id_ in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(piece[3:5], 16)])
            if self.model.is_byte(id_)
            else piece.replace("▁", " ").encode()
            for id_, piece in enumerate(pieces)
        ]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        # White space that some piece has after something else: there the text is not cut.
        after = re.compile(f"(?<=[^▁{_BLANKS}])[▁{_BLANKS}]")
        found = {blank for piece in pieces for blank in after.findall(piece)}
        self.joining = "".join(found).replace("▁", " ")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@functools.cache
def _tokenizer(kind: type, path: str):
    return kind(path)


def coalesced(starts: np.ndarray, ends: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, ...]:
    """The order of the intervals by start, and the group of each in that order."""
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = starts[order][1:] >= reach[:-1]
    return order, np.concatenate([[0], np.cumsum(breaks)])


def overlaps(
    a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (index of A, index of B) of intervals that share a byte, by A and then B."""
    first = np.searchsorted(b_ends, a_starts, "right")
    number = np.searchsorted(b_starts, a_ends, "left") - first
    upto = np.cumsum(number)
    a = np.repeat(np.arange(len(a_starts)), number)
    return a, np.arange(len(a)) - np.repeat(upto - number, number) + np.repeat(first, number)


class _Table:
    """What is known of the segments met so far, by their number."""

    def __init__(self, a: _ByteLevel, b: _Pieces):
        self.a, self.b = a, b
        cuts = set(_BLANKS) - set(a.joining) - set(b.joining)
        self.cuts = np.isin(np.arange(256), [ord(blank) for blank in cuts])
        # Every id as text, with what may follow it.
        ids = range(max(len(a.bytes), len(b.bytes)))
        self.shown = [[b"%d" % i + mark for i in ids] for mark in (b",", b"|", b";")]
        self.clear()

    def clear(self) -> None:
        self.number: dict[int, int] = {}  # by hash
        self.filled = 0  # bytes
        self.groups: list[bytes | None] = []  # as text; None if a tokenizer changes the bytes
        self.counts = np.zeros((0, 4), np.int64)  # tokens of A and B, groups, links
        self.link_ends = np.zeros(1, np.int64)
        self.links = np.zeros(0, np.int64)  # A's id * len(b.bytes) + B's id

    def add(self, hashes: list[int], segments: list[bytes]) -> None:
        """Aligns new segments: those that may stand side by side many at a time."""
        batches: list[list[int]] = [[]]
        for i, segment in enumerate(segments):
            if not (self.cuts[0x20] and ends_whole(segment)):
                batches[-1:-1] = [[i]]
                continue
            if len(batches[-1]) == JOINED:
                batches.append([])
            batches[-1].append(i)
        batches = [batch for batch in batches if batch]
        for first in range(0, len(batches), 64):
            some = batches[first : first + 64]
            texts = [b"".join([segments[i] for i in batch]) for batch in some]
            found = [[t.encode([text.decode() for text in texts]) for t in (self.a, self.b)]]
            for batch, text, a, b in zip(some, texts, *found[0]):
                if self._same(a, b, text):
                    self._align([(hashes[i], len(segments[i])) for i in batch], a, b)
                    continue
                for i in batch:
                    a, b = (t.encode([segments[i].decode()])[0] for t in (self.a, self.b))
                    if self._same(a, b, segments[i]):
                        self._align([(hashes[i], len(segments[i]))], a, b)
                    else:
                        self._append(hashes[i], len(segments[i]), None)
                        self._extend(np.zeros((1, 4), np.int64), np.zeros(0, np.int64), [0])

    def _same(self, a: list[int], b: list[int], text: bytes) -> bool:
        tables = self.a.bytes, self.b.bytes
        return all(b"".join([t[i] for i in ids]) == text for t, ids in zip(tables, (a, b)))

    def _append(self, hash_: int, size: int, groups: bytes | None) -> None:
        self.number[hash_] = len(self.groups)
        self.groups.append(groups)
        self.filled += size + SEGMENT_BYTES

    def _extend(self, counts: np.ndarray, links: np.ndarray, numbers) -> None:
        self._pending.append((counts, links, np.asarray(numbers, np.int64)))

    def _align(self, members: list[tuple[int, int]], a: list[int], b: list[int]) -> None:
        """The segments, which follow each other in one text that the ids stand for."""
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ids = np.concatenate([a, b])
        a_ends, b_ends = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        a_starts, b_starts = (np.concatenate([[0], e[:-1]]) for e in (a_ends, b_ends))
        starts, ends = np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends])
        side = np.repeat([0, 1], [len(a), len(b)])
        order, group = coalesced(starts, ends, side)
        stops = np.cumsum([size for _, size in members])
        # Groups lie within segments; within a group A's ids come first.
        token = order[np.lexsort((starts[order], side[order], group))]
        group = np.sort(group)
        owner = np.searchsorted(stops, starts[token], "right")
        last = np.append(np.flatnonzero(group[1:] != group[:-1]), len(group) - 1)
        mark = np.where(side[token][1:] != side[token][:-1], 1, 0)
        mark = np.append(mark, 2)
        mark[last] = 2
        parts = [self.shown[m][i] for m, i in zip(mark.tolist(), ids[token].tolist())]
        cuts = np.searchsorted(owner, np.arange(len(members) + 1)).tolist()
        for (hash_, size), first, stop in zip(members, cuts[:-1], cuts[1:]):
            self._append(hash_, size, b"".join(parts[first:stop])[:-1])
        i, j = overlaps(a_starts, a_ends, b_starts, b_ends)
        in_a, in_b = (np.searchsorted(stops, s, "right") for s in (a_starts, b_starts))
        found = [in_a, in_b, owner[last], in_a[i]]
        counts = np.stack([np.bincount(f, minlength=len(members)) for f in found], axis=1)
        self._extend(counts, a[i] * len(self.b.bytes) + b[j], counts[:, 3])

    def numbers(self, hashes: np.ndarray, segments) -> np.ndarray:
        """The number of each distinct hash; `segments(i)` is the bytes of the i-th."""
        if self.filled > TABLE_BYTES:
            self.clear()
        known = self.number
        values = hashes.tolist()
        new = [i for i, value in enumerate(values) if value not in known]
        self._pending = []
        self.add([values[i] for i in new], [segments(i) for i in new])
        if self._pending:
            counts, links, numbers = zip(*self._pending)
            self.counts = np.concatenate([self.counts, *counts])
            self.links = np.concatenate([self.links, *links])
            ends = self.link_ends[-1] + np.cumsum(np.concatenate(numbers))
            self.link_ends = np.concatenate([self.link_ends, ends])
        return np.array([known[value] for value in values], np.int64)


def _document_links(table: _Table, document: np.ndarray, segment: np.ndarray, documents: int):
    """Of each document the distinct linked pairs and how often each occurs."""
    size = len(table.groups)
    both, times = np.unique(document * size + segment, return_counts=True)
    document, segment = both // size, both % size
    number = np.diff(table.link_ends)[segment]
    upto = np.cumsum(number)
    at = np.repeat(table.link_ends[segment] - (upto - number), number) + np.arange(number.sum())
    # Both in one number: ids have 17 bits or fewer, and a block has few documents.
    width = len(table.a.bytes) * len(table.b.bytes)
    if documents * width >= 1 << 63:
        raise ValueError("the vocabularies are too large")
    key, times = np.repeat(document, number) * width + table.links[at], np.repeat(times, number)
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    times = np.add.reduceat(times, first) if len(first) else times
    document, pair = key[first] // width, key[first] % width
    pair = pair // len(table.b.bytes) << 32 | pair % len(table.b.bytes)
    return pair, times, np.searchsorted(document, np.arange(documents + 1))


def _aligned(a_path: str, b_path: str, text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Table(_tokenizer(_ByteLevel, a_path), _tokenizer(_Pieces, b_path))
        for batch in regrouped(batches, TEXT_BYTES):
            for first, last in blocks(batch.column("size").to_numpy(), TEXT_BYTES):
                yield _block(table, batch.slice(first, last - first), text)

    return run


def _block(table: _Table, batch: pa.RecordBatch, text: bool) -> pa.RecordBatch:
    texts = [t.encode() for t in batch.column("text").to_pylist()]
    whole = b"".join([b" " + t for t in texts])
    data = np.frombuffer(whole, np.uint8)
    ends = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    starts, cut = _segment_starts(data), np.zeros(len(data) + 1, bool)
    cut[starts[table.cuts[data[starts]]]] = True
    cut[ends] = True
    starts = np.flatnonzero(cut[:-1])
    stops = np.append(starts[1:], len(data))
    hashes = run_hashes(byte_sums(data), starts, stops)
    distinct, firsts, which = np.unique(hashes, return_index=True, return_inverse=True)
    numbers = table.numbers(distinct, lambda i: whole[starts[firsts[i]] : stops[firsts[i]]])
    segment = numbers[which]
    document = np.searchsorted(ends, starts, "right") - 1
    cuts = np.searchsorted(document, np.arange(len(texts) + 1)).tolist()
    groups, digests, own = [], [], segment.tolist()
    for i, (first, stop) in enumerate(zip(cuts[:-1], cuts[1:])):
        found = [table.groups[n] for n in own[first:stop]]
        if not texts[i] or None in found:
            segment[first:stop] = -1
            groups.append(b"")
            digests.append("")
            continue
        joined = b";".join(found)
        groups.append(joined if text else b"")
        digests.append(hashlib.sha256(joined).hexdigest())
    used = segment >= 0
    document, segment = document[used], segment[used]
    counts = [
        np.bincount(document, table.counts[segment, k], len(texts)).astype(np.int64)
        for k in range(4)
    ]
    pair, times, at = _document_links(table, document, segment, len(texts))
    offsets = pa.array(at, pa.int32())
    columns = {
        "row": batch.column("row"),
        "doc_id": batch.column("doc_id"),
        **{n: pa.array(c) for n, c in zip(("n_a", "n_b", "n_groups", "n_links"), counts)},
        "groups_sha256": pa.array(digests, pa.string()),
        "pairs": pa.ListArray.from_arrays(offsets, pa.array(pair, pa.int64())),
        "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
    }
    if text:
        columns["groups"] = pa.array([g.decode() for g in groups], pa.string())
    return pa.RecordBatch.from_pydict(columns)


def alignments(docs: DataFrame, a_path: str, b_path: str, text: bool = True) -> DataFrame:
    """The alignment of each document, written and read again.

    Per row of `docs`: `row` (a number of its own), `doc_id`, `n_a` and `n_b` (tokens), `n_groups`,
    `n_links` (overlapping pairs of tokens), `groups_sha256`, `pairs` (the distinct pairs of linked
    ids, A's in the upper 32 bits), `times` (how often each occurs) and, with `text`, `groups`:
    `a1,a2|b1;a3|b2,b3`, ids in order. A null or empty text, or one that a tokenizer changes, has
    no tokens: zeros, and an empty text instead of groups and digest. Rows that repeat are each a
    document.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
        F.octet_length(text_of()).alias("size"),
    )
    schema = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, pairs array<long>, times array<long>"
    )
    if text:
        schema += ", groups string"
    found = rows.mapInArrow(_aligned(a_path, b_path, text), schema)
    return materialise(found, "alignments")


def _a_of(pair: Column) -> Column:
    return F.shiftright(pair, 32)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per linked `pair` the number of documents that have it (`count`), and whether none of the
    same A id is in more (`best`)."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair")
    counts = materialise(counts.agg(F.count(F.lit(1)).alias("count")), "pairs")
    highest = counts.groupBy(_a_of(F.col("pair")).alias("a")).agg(F.max("count").alias("most"))
    joined = counts.join(highest, _a_of(counts["pair"]) == highest["a"])
    return joined.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def link_strengths(
    docs: DataFrame, a_path: str, b_path: str, limit: int = BROADCAST_PAIRS
) -> DataFrame:
    """`alignments` without the links, and what the corpus says of each document's links.

    `n_best`: links whose pair is in as many documents as any of its A id; `count_sum`: the number
    of documents with the pair, summed over the links. The counts of pairs are broadcast if
    there are at most `limit` of them, which is checked; otherwise the links are shuffled by pair.
    """
    aligned = alignments(docs, a_path, b_path, text=False)
    counts = materialise(pair_counts(aligned), "strengths")
    few = counts.count() <= limit
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    sums = (
        links.join(F.broadcast(counts) if few else counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
        .withColumnRenamed("row", "of")
    )
    zero = F.lit(0).cast("long")
    return aligned.join(sums, aligned["row"] == sums["of"], "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
