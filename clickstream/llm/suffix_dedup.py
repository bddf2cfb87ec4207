"""Deduplication of byte substrings by context hashes and suffix order.

Suffixes are sorted where they can matter. Documents are joined on the anchors of their byte
windows (`repeats`); equal surroundings are folded, and the suffixes of what is left around an
anchor are put in suffix order. Longest previous factors are not computed: of each unbroken
stretch of full-length common prefixes the smallest document stays, the others are copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from clickstream.llm.hashing import few_rows
from clickstream.llm.repeats import LAST, Unit, covered, repeated_windows

BYTES = 50
SEED = 14  # bytes of an anchor; shorter ones recur by chance


def suffix_order(text: bytes, starts: np.ndarray, length: int, *first: np.ndarray):
    """The order of the suffixes at `starts`, cut off at `length`, and the common prefix of each
    with the one before. Rows are grouped by the keys `first`, in which order does not matter."""
    padded = np.frombuffer(text + b"\0" * (length + 8), np.uint8)
    columns = []
    for at in range(0, length, 8):
        word = np.zeros(len(starts), np.uint64)
        for k in range(min(8, length - at)):
            word |= padded[starts + at + k].astype(np.uint64) << np.uint64(8 * (7 - k))
        columns.append(word)
    order = np.lexsort((*columns[::-1], *first[::-1]))
    common = np.zeros(len(starts), np.int64)
    same = np.ones(max(0, len(starts) - 1), bool)
    for key in first:
        same &= key[order][1:] == key[order][:-1]
    for at, word in enumerate(columns):
        differ = word[order][1:] ^ word[order][:-1]
        # The leading equal bytes of this part, counted while all before were equal.
        equal = np.zeros(len(differ), np.int64)
        for k in range(1, 1 + min(8, length - 8 * at)):
            equal += differ >> np.uint64(8 * (8 - k)) == 0
        common[1:] += np.where(same, equal, 0)
        same &= differ == 0
    return order, common


def previous_factors(position: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes, in suffix order, match an earlier position over the whole `length`.

    The longest earlier match of a suffix is the longer of the common prefixes with the previous
    and the next smaller position in suffix order, and it reaches `length` if the entries from
    there to here all do: if some position in the unbroken stretch around it is smaller.
    """
    broken = common < length
    broken[:1] = True
    starts = np.flatnonzero(broken)
    if not len(starts):
        return np.zeros(0, bool)
    earliest = np.minimum.reduceat(position, starts)
    return position > earliest[np.cumsum(broken) - 1]


def earlier_matches(unit: Unit, symbols: bytes, starts, anchors, docs) -> np.ndarray:
    """Which windows have a full-length match in a smaller document."""
    order, common = suffix_order(symbols, starts, unit.window, anchors)
    copies = np.zeros(len(starts), bool)
    copies[order] = previous_factors(docs[order], common, unit.window)
    return copies


def repeated_bytes(
    docs: DataFrame, window: int = BYTES, seed: int = SEED, text: bool = True
) -> DataFrame:
    """What each document repeats of documents with smaller ids, in maximal runs of bytes.

    Returns per row `doc_id`, `n_bytes`, `spans` (byte ranges, `start` to before `end`),
    `n_removed` and `kept_sha256`, and with `text` also `kept`, the other bytes: a cut may fall
    within a character. Matches never cross documents and are judged on the input. A null text is
    empty.
    """
    unit = Unit("bytes", window, min(seed, window))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(span)),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
    if text:
        fields.append(T.StructField("kept", T.BinaryType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        number = pa.int64()
        types = {"doc_id": number, "n_bytes": number, "spans": spans, "n_removed": number,
                 "kept_sha256": pa.string(), "kept": pa.binary()}
        for batch in few_rows(batches):
            out = {field.name: [] for field in fields}
            columns = [batch.column(name).to_pylist() for name in ("doc", "text", "marks")]
            for doc, whole, marks in zip(*columns):
                data = whole.encode()
                runs = covered(unit, marks, len(data)).tolist()
                edges = [0, *(edge for run in runs for edge in run), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out["doc_id"].append(None if doc == LAST else doc)
                out["n_bytes"].append(len(data))
                out["spans"].append([{"start": a, "end": b} for a, b in runs])
                out["n_removed"].append(len(data) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if text:
                    out["kept"].append(kept)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, types[k]) for k, v in out.items()})

    return repeated_windows(docs, unit, earlier_matches).mapInArrow(cut, T.StructType(fields))
