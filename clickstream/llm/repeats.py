"""Repeated windows of symbols across documents, found by winnowed anchors.

A window is `window` consecutive symbols (words or bytes) of one document. It repeats if the same
symbols also start in a document of a smaller id. Shipping every window would move many times the
text; so each window is stood for by its anchor, the `seed` symbols of the smallest hash within
it. Equal windows have equal anchors, and the windows that share an anchor's place are one
*context*, a run of symbols around it.

1. Each task winnows its documents and drops the contexts that an earlier document of the task
   has as well: those are repeats already, and a passage in a third of all documents leaves the
   task once.
2. Contexts meet by the hash of their anchor. Equal contexts of later documents are repeats. An
   anchor in one context only is done.
3. The first documents of an anchor's different contexts are compared window by window, with the
   contexts' symbols (`resolve`). Few contexts get here: the ends of repeated passages.

Contexts are equal if all 64 bits of their hashes are, besides 32 of the anchor's and the bucket's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clickstream.llm.common import materialise, partitions, row_key, ship, text_of
from clickstream.llm.hashing import (
    blocks,
    byte_sums,
    few_rows,
    regrouped,
    run_hashes,
    run_sums,
    sliding_minimum,
    words,
)

GROUP_BYTES = 8 << 20  # of text in which a task looks for repeats of its own
LAST = np.iinfo(np.int64).max  # stands for a null id, which comes after all others

# A mark holds the number of windows in its lowest bits; places within a context are as wide.
COUNT_BITS = 16
MOST = (1 << 15) - 1


@dataclass(frozen=True)
class Unit:
    """What a document consists of, and how long a repeat has to be: at most `MOST` symbols."""

    kind: str  # "words" or "bytes"
    window: int
    seed: int

    def __post_init__(self):
        if not 1 <= self.seed <= self.window <= MOST:
            raise ValueError(f"a window has between seed and {MOST} symbols, a seed at least one")

    @property
    def reach(self) -> int:
        """How many windows can share an anchor."""
        return self.window - self.seed + 1

    @property
    def left_half(self) -> int:
        """A window that reaches so far to the left of its anchor belongs to the left side."""
        return (self.window - self.seed + 1) // 2


def _encoded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text begins and the last one ends."""
    parts = [text.encode() for text in texts.to_pylist()]
    ends = np.cumsum([0] + [len(part) for part in parts])
    return np.frombuffer(b"".join(parts), np.uint8), ends


def symbol_sums(unit: Unit, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums for the hashes of runs of symbols, and where each text's symbols begin and end."""
    if unit.kind == "bytes":
        return byte_sums(data), ends
    starts, stops = words(data, ends[:-1])
    hashes = run_hashes(byte_sums(data), starts, stops)
    return run_sums(hashes), np.searchsorted(starts, ends)


def winnow(unit: Unit, sums: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """The contexts of all texts: `text`, `lo` (first symbol within the text), `count` (windows
    from there on), `at` (the anchor's place within the context), and the hashes `anchor` and
    `context`, and `left` and `right`.

    Every window of a context reaches at least half of what a window has besides its anchor to
    one side. `left` and `right` are the hashes of the anchor with that half, or of the context
    where it has no such window, so contexts that differ in both share no window.
    """
    total, window = len(sums) - 1, unit.window
    if total < window:
        none = {name: np.zeros(0, np.int64) for name in ("text", "lo", "count", "at")}
        return none | {k: np.zeros(0, np.uint64) for k in ("anchor", "context", "left", "right")}
    places = np.arange(total - unit.seed + 1)
    grams = run_hashes(sums, places, places + unit.seed)
    bits = np.uint64(max(24, int(total).bit_length()))
    smallest = sliding_minimum((grams >> bits << bits) | places.astype(np.uint64), unit.reach)
    # Windows that lie within a text.
    step = np.zeros(total + 1, np.int8)
    long_ = np.diff(ends) >= window
    step[ends[:-1][long_]] += 1
    step[ends[1:][long_] - window + 1] -= 1
    valid = np.add.accumulate(step)[: len(smallest)] > 0
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (smallest[1:] != smallest[:-1])
    lo = np.flatnonzero(begins)
    stops = np.append(lo[1:], len(valid))
    inside = np.add.accumulate(valid.astype(np.int64))
    count = inside[stops - 1] - inside[lo] + 1
    anchor_at = (smallest[lo] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.searchsorted(ends, lo, side="right") - 1
    stop = lo + count + window - 1
    context = run_hashes(sums, lo, stop)
    far_left = anchor_at - unit.left_half
    far_right = far_left + 1 + window
    left = run_hashes(sums, np.maximum(far_left, 0), anchor_at + unit.seed)
    right = run_hashes(sums, anchor_at, np.minimum(far_right, total))
    return {
        "text": text,
        "lo": lo - ends[text],
        "count": count,
        "at": anchor_at - lo,
        "anchor": grams[anchor_at],
        "context": context,
        "left": np.where(far_left >= lo, left, context),
        "right": np.where(far_right <= stop, right, context),
    }


def _smallest_of_equal(doc: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the smallest `doc` of the rows with equal keys, and the number of its group."""
    order = np.lexsort((doc, *keys))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    number = np.cumsum(new) - 1
    smallest = np.empty(len(doc), doc.dtype)
    smallest[order] = doc[order][new][number] if len(doc) else doc
    group = np.empty(len(doc), np.int64)
    group[order] = number
    return smallest, group


_RECORD = {
    "anchor": np.int32, "context": np.int64, "doc": np.int64, "row": np.int64, "lo": np.int32,
    "count": np.int16, "left": np.int8, "right": np.int8,
}
_RECORD_SCHEMA = "bucket int, " + ", ".join(
    f"{name} binary" for name in (*_RECORD, "done_doc", "done_row", "done_mark")
)
_MARKS = "doc long, row long, mark long, wanted byte"


def _mark(lo: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The first symbol and the number of windows in one number."""
    return lo.astype(np.int64) << COUNT_BITS | count.astype(np.int64)


def _documents(docs: DataFrame) -> DataFrame:
    """What is read of a document; rows that repeat id and text are the same to all steps."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("doc"),
        row_key().alias("row"),
        text_of().alias("text"),
        F.octet_length(text_of()).alias("size"),
    )


def _contexts(unit: Unit, buckets: int) -> Callable:
    def found(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        data, ends = _encoded(batch.column("text"))
        parts = []
        for first, last in blocks(np.diff(ends)):
            inner = ends[first : last + 1]
            sums, marks = symbol_sums(unit, data[inner[0] : inner[-1]], inner - inner[0])
            part = winnow(unit, sums, marks)
            part["text"] = part["text"] + first
            parts.append(part)
        return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, GROUP_BYTES):
            record = found(batch)
            text = record.pop("text")
            record["doc"] = batch.column("doc").to_numpy()[text]
            record["row"] = batch.column("row").to_numpy()[text]
            bucket = (record["anchor"] >> np.uint64(32)) % np.uint64(buckets)
            smallest, _ = _smallest_of_equal(record["doc"], record["context"], record["anchor"])
            done = record["doc"] > smallest
            yield _by_bucket(record, bucket.astype(np.int64), done, buckets)
            pa.default_memory_pool().release_unused()

    return run


def _parts(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())


def _by_bucket(record, bucket, done, buckets) -> pa.RecordBatch:
    """A row per bucket: the contexts that go there, and a share of the repeats already known."""
    order = np.argsort(np.where(done, buckets, bucket), kind="stable")
    order = order[: len(bucket) - int(done.sum())]
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    columns = {"bucket": pa.array(np.arange(buckets, dtype=np.int32))}
    for name, dtype in _RECORD.items():
        values = record[name][order].astype(dtype, casting="unsafe")
        if name == "doc":  # differences compress better
            first = np.zeros(len(values), bool)
            first[cuts[:-1][cuts[:-1] < cuts[1:]]] = True
            before = np.concatenate([values[:1], values[:-1]])
            values = np.where(first, values, values - before)
        columns[name] = _parts(values, cuts)
    shares = np.linspace(0, int(done.sum()), buckets + 1).astype(np.int64)
    known = {
        "done_doc": record["doc"][done],
        "done_row": record["row"][done],
        "done_mark": _mark(record["lo"][done], record["count"][done]),
    }
    for name, values in known.items():
        columns[name] = _parts(values, shares)
    return pa.RecordBatch.from_pydict(columns)


def _joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype)


def _several(group: np.ndarray, anchor: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Whether the same anchor and side occur with another group too."""
    order = np.lexsort((side, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (side[order][1:] != side[order][:-1])
    starts = np.flatnonzero(new)
    out = np.zeros(len(order), bool)
    if len(starts):
        sorted_ = group[order]
        differ = np.minimum.reduceat(sorted_, starts) != np.maximum.reduceat(sorted_, starts)
        out[order] = differ[np.cumsum(new) - 1]
    return out


def _meet(table: pa.Table) -> pa.Table:
    """The repeats of a bucket, and the contexts that have to be compared, on which sides
    (`wanted`: 1 for the left, 2 for the right, 3 for both)."""
    record = {name: _joined(table, name, dtype) for name, dtype in _RECORD.items()}
    docs = [np.cumsum(np.frombuffer(part, np.int64)) for part in table.column("doc").to_pylist()]
    record["doc"] = np.concatenate(docs)
    smallest, group = _smallest_of_equal(record["doc"], record["context"], record["anchor"])
    repeat = record["doc"] > smallest
    mixed = _several(group, record["anchor"], record["left"]).astype(np.int8)
    mixed += 2 * _several(group, record["anchor"], record["right"]).astype(np.int8)
    told = repeat | (mixed > 0)
    return pa.table(
        {
            "doc": np.concatenate([record["doc"][told], _joined(table, "done_doc", np.int64)]),
            "row": np.concatenate([record["row"][told], _joined(table, "done_row", np.int64)]),
            "mark": np.concatenate(
                [_mark(record["lo"], record["count"])[told], _joined(table, "done_mark", np.int64)]
            ),
            "wanted": np.concatenate(
                [
                    np.where(repeat, 0, mixed)[told].astype(np.int8),
                    np.zeros(len(_joined(table, "done_doc", np.int64)), np.int8),
                ]
            ),
        }
    )


def _cut_contexts(unit: Unit, buckets: int) -> Callable:
    """The symbols of the wanted contexts, by the bucket of their anchor and one side of it.

    With the side, even a very common anchor is spread over many buckets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            names = ("doc", "row", "text", "marks")
            docs, rows, marks, wanted, contexts = [], [], [], [], []
            for doc, row, text, told in zip(*[batch.column(name).to_pylist() for name in names]):
                symbols, size = _symbols(unit, text), unit_bytes(unit)
                for mark in told:
                    mark, sides = mark >> 2, mark & 3
                    lo, count = mark >> COUNT_BITS, mark & MOST
                    docs.append(doc)
                    rows.append(row)
                    marks.append(mark)
                    wanted.append(sides)
                    contexts.append(symbols[lo * size : (lo + count + unit.window - 1) * size])
            if not contexts:
                continue
            found = _anchored(unit, contexts)
            for side, name in ((1, "left"), (2, "right")):
                here = np.flatnonzero(np.array(wanted) & side)
                key = found[name][here]
                columns = {
                    "bucket": ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32),
                    "key": key.view(np.int64),
                    "side": np.full(len(here), side, np.int8),
                    "at": found["at"][here].astype(np.int16),
                    "doc": np.array(docs, np.int64)[here],
                    "row": np.array(rows, np.int64)[here],
                    "mark": np.array(marks, np.int64)[here],
                }
                columns = {name: pa.array(values) for name, values in columns.items()}
                columns["context"] = pa.array([contexts[i] for i in here], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def unit_bytes(unit: Unit) -> int:
    return 1 if unit.kind == "bytes" else 8


def _symbols(unit: Unit, text: str) -> bytes:
    """The text's bytes, or the 64-bit hashes of its words."""
    if unit.kind == "bytes":
        return text.encode()
    data = np.frombuffer(text.encode(), np.uint8)
    starts, stops = words(data, np.zeros(1, np.int64))
    return run_hashes(byte_sums(data), starts, stops).tobytes()


def _anchored(unit: Unit, contexts: list[bytes]) -> dict[str, np.ndarray]:
    """Each context anew as the only one of a text."""
    size = unit_bytes(unit)
    ends = np.cumsum([0] + [len(context) // size for context in contexts])
    joined = b"".join(contexts)
    if unit.kind == "bytes":
        sums = byte_sums(np.frombuffer(joined, np.uint8))
    else:
        sums = run_sums(np.frombuffer(joined, np.uint64))
    return winnow(unit, sums, ends)


def _resolved(unit: Unit, resolve: Callable) -> Callable:
    """The repeated windows of the contexts of a bucket, of the side that each is there for."""

    def run(table: pa.Table) -> pa.Table:
        doc, row, mark, key, side, at = (
            table.column(name).to_numpy() for name in ("doc", "row", "mark", "key", "side", "at")
        )
        contexts = table.column("context").to_pylist()
        count = mark & MOST
        # One entry per window: its context and the place of its first symbol in all contexts.
        sizes = np.array([len(c) // unit_bytes(unit) for c in contexts], np.int64)
        begins = np.cumsum(sizes) - sizes
        which = np.repeat(np.arange(len(contexts)), count)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        own = (at[which] - nth >= unit.left_half) == (side[which] == 1)
        which, nth = which[own], nth[own]
        hit = resolve(unit, b"".join(contexts), begins[which] + nth, key[which], doc[which])
        # Consecutive repeated windows of a context are one mark.
        new = hit.copy()
        new[1:] &= ~hit[:-1] | (which[1:] != which[:-1])
        first = np.flatnonzero(new)
        run_of = np.cumsum(new)[hit] - 1
        length = np.bincount(run_of, minlength=len(first))
        of = which[first]
        return pa.table(
            {
                "doc": doc[of],
                "row": row[of],
                "mark": _mark((mark[of] >> COUNT_BITS) + nth[first], length),
            }
        )

    return run


def repeated_windows(docs: DataFrame, unit: Unit, resolve: Callable) -> DataFrame:
    """`doc`, `row`, `text` and `marks` of every document.

    `marks` tells its repeated windows: the first symbol of a run of them, shifted by `COUNT_BITS`,
    and their number. It is null for a document without one. `doc_id` is an integer; a null one comes
    after all others, and its rows do not repeat each other. Documents shorter than a window have
    no windows, and null texts are empty.
    """
    spark = docs.sparkSession
    ship(spark)
    buckets = 4 * partitions(spark)
    documents = _documents(docs)
    found = documents.mapInArrow(_contexts(unit, buckets), _RECORD_SCHEMA)
    marks = materialise(found.groupBy("bucket").applyInArrow(_meet, _MARKS), "repeat-marks")
    texts = documents.select("doc", "row", "text")
    sides = F.shiftleft("mark", 2).bitwiseOR(F.col("wanted").cast("long"))
    wanted = marks.filter("wanted > 0").groupBy("doc", "row")
    wanted = wanted.agg(F.collect_set(sides).alias("marks"))
    contexts = texts.join(wanted, ["doc", "row"]).mapInArrow(
        _cut_contexts(unit, buckets),
        "bucket int, key long, side byte, at short, doc long, row long, mark long, context binary",
    )
    resolved = contexts.groupBy("bucket").applyInArrow(
        _resolved(unit, resolve), "doc long, row long, mark long"
    )
    known = marks.filter("wanted = 0").select("doc", "row", "mark").unionByName(resolved)
    known = known.groupBy("doc", "row").agg(F.collect_list("mark").alias("marks"))
    return texts.join(known, ["doc", "row"], "left")


def covered(unit: Unit, marks: list[int] | None, total: int) -> np.ndarray:
    """Starts and stops of the maximal runs of symbols within repeated windows."""
    if not marks:
        return np.zeros((0, 2), np.int64)
    marks = np.array(marks, np.int64)
    lo = marks >> COUNT_BITS
    step = np.zeros(total + 1, np.int32)
    np.add.at(step, lo, 1)
    np.add.at(step, lo + (marks & MOST) + unit.window - 1, -1)
    inside = np.concatenate([[False], np.cumsum(step)[:-1] > 0, [False]])
    return np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
