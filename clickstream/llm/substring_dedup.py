"""Substring deduplication over words: seed and extend.

Documents are joined on the winnowed anchors of their word windows (`repeats`). Where an anchor
has different surroundings, it is extended to both sides as far as a window reaches: contexts that
agree on an extension of full length share a repeat. Adjoining repeats merge to maximal ones, of
which every document but the first loses its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from clickstream.llm.hashing import few_rows, run_hashes, run_sums
from clickstream.llm.repeats import LAST, Unit, _smallest_of_equal, covered, repeated_windows

WORDS = 13
SEED = 5  # words of an anchor


def extend(unit: Unit, symbols: bytes, starts, anchors, docs) -> np.ndarray:
    """Which windows also occur around the same anchor in a smaller document.

    The window of a context that starts some words before the anchor is the anchor's extension by
    these words to the left and by the rest to the right.
    """
    sums = run_sums(np.frombuffer(symbols, np.uint64))
    extended = run_hashes(sums, starts, starts + unit.window)
    smallest, _ = _smallest_of_equal(docs, extended, anchors)
    return docs > smallest


def repeated_words(
    docs: DataFrame, window: int = WORDS, seed: int = SEED, text: bool = True
) -> DataFrame:
    """What each document repeats of documents with smaller ids, in maximal runs of words.

    Returns per row `doc_id`, `n_words`, `spans` (word ranges, `start` to before `end`),
    `n_removed` and `kept_sha256`, and with `text` also `kept`: the other words, joined by single
    spaces. Words are runs without white space. Windows never cross documents, and are judged on
    the input. A null text has no words.
    """
    unit = Unit("words", window, min(seed, window))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(span)),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
    if text:
        fields.append(T.StructField("kept", T.StringType()))
    schema = T.StructType(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            out = {field.name: [] for field in fields}
            columns = [batch.column(name).to_pylist() for name in ("doc", "text", "marks")]
            for doc, whole, marks in zip(*columns):
                words = whole.encode().split()  # bytes split at ASCII white space only
                runs = covered(unit, marks, len(words)).tolist()
                stay, at = [], 0
                for start, end in runs:
                    stay += words[at:start]
                    at = end
                kept = b" ".join(stay + words[at:])
                out["doc_id"].append(None if doc == LAST else doc)
                out["n_words"].append(len(words))
                out["spans"].append([{"start": a, "end": b} for a, b in runs])
                out["n_removed"].append(sum(b - a for a, b in runs))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if text:
                    out["kept"].append(kept.decode())
            yield _batch(out)

    def _batch(out: dict) -> pa.RecordBatch:
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        number, string = pa.int64(), pa.string()
        types = {"doc_id": number, "n_words": number, "spans": spans, "n_removed": number,
                 "kept_sha256": string, "kept": string}
        return pa.RecordBatch.from_pydict({k: pa.array(v, types[k]) for k, v in out.items()})

    return repeated_windows(docs, unit, extend).mapInArrow(cut, schema)
