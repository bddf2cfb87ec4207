"""Toxicity by compression distance: which of two dictionaries compresses a text better.

One zstandard dictionary is trained on toxic text and one on ordinary text. Insults are single words
within otherwise ordinary prose, in some languages with any ending, so a window is a part of a word:
each run of `PART` letters of it, a blank before and after the word counting as letters. A window
that takes fewer bytes with the toxic dictionary is nearer to toxic text. It is written `REPEAT`
times, as a shorter input leaves the compressor nothing to save. The toxic text consists of the
parts that are significantly more frequent in toxic documents, without the prose around them; the
language is not asked for. How many bytes a window has to save, and what the rate of words with such
a window says of a document, is calibrated on documents that the dictionaries have not seen.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from clickstream.llm.common import ship, text_of
from clickstream.llm.hashing import blocks

SAMPLE = 2000  # labelled documents of each class that the model is fitted on, at most
LONGEST = 1 << 16  # bytes of such a document
HELD_OUT = 2  # remainder of crc32(doc_id) by 4 whose labels are never read
PREDICTED = 0.3
DICTIONARY = 12_000  # bytes of each; in 16,384 or more zstandard finds nothing for so short a text
PART = 5  # letters of a window
REPEAT = 3
ERROR = 0.01  # probability that any part at all is taken for toxic by chance
TIMES = (1, 2, 4)  # a part is counted in documents that have it at least so often
FOLDS = 4  # of which each is calibrated on dictionaries of the others
_WORD = re.compile("[a-z\x80-\U0010ffff]+")


@dataclass(frozen=True)
class Model:
    """Two dictionaries and what hits, words with a toxic window, say of a document."""

    toxic: bytes
    ordinary: bytes
    saved: int  # bytes that a toxic window saves, at least
    rates: tuple[float, float]  # hits per word in ordinary and in toxic documents
    line: tuple[float, float]  # log odds: the first, and the second times the evidence

    def scores(self, words: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """The probability of the label 1, of documents with so many words and hits."""
        odds = self.line[0] + self.line[1] * _evidence(words, hits, self.rates)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-odds))


def words_of(text: str) -> list[str]:
    """Runs of letters: a-z after lower case, and all beyond ASCII."""
    return _WORD.findall(text.lower())


def parts_of(word: str) -> list[str]:
    """The windows of a word."""
    word = f" {word} "
    return [word[i : i + PART] for i in range(max(1, len(word) - PART + 1))]


def letters(text: str) -> bytes:
    """One byte a letter, so that a window is as long in any script.

    The byte is the letter's code up to 255; beyond, letters 128 codes apart share one.
    """
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return bytes(code if code < 128 else 128 | code & 127 for code in map(ord, text))


def window(part: str) -> bytes:
    return letters(part) * REPEAT


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; the text itself if there is too little to train on."""
    content = b"".join(samples)
    if not content:
        return b""
    try:
        repeated = samples * (1 + 2000 // len(samples))
        return zstandard.train_dictionary(DICTIONARY, repeated, k=32, d=6, level=19).as_bytes()
    except zstandard.ZstdError:
        return content[-DICTIONARY:]


def _compressor(dictionary: bytes):
    """Both dictionaries are searched in the same way: a level alone would go by their sizes.

    They serve as text alone; their code tables would differ by more than a window does.
    """
    search = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=16, hash_log=16, search_log=7, min_match=5, target_length=64,
        strategy=zstandard.STRATEGY_LAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    if not dictionary:
        return zstandard.ZstdCompressor(compression_params=search).compress
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=search)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=search).compress


class Savings:
    """How many bytes the toxic dictionary saves on the best window of each word."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self._toxic, self._ordinary = _compressor(toxic), _compressor(ordinary)
        self._plain = _compressor(b"")
        self._words: dict[str, int] = {}
        self._parts: dict[str, int] = {}

    def __call__(self, words: list[str]) -> list[int]:
        known = self._words
        if len(known) > 500_000:  # what is forgotten is computed again
            known.clear()
        for word in {word for word in words if word not in known}:
            known[word] = max(map(self._part, parts_of(word)))
        return [known[word] for word in words]

    def _part(self, part: str) -> int:
        saved = self._parts.get(part)
        if saved is None:
            if len(self._parts) > 500_000:
                self._parts.clear()
            text = window(part)
            # Scattered short matches can make the output longer than no dictionary does.
            ordinary = min(len(self._ordinary(text)), len(self._plain(text)))
            saved = self._parts[part] = ordinary - len(self._toxic(text))
        return saved


class _Counts:
    """In how many documents of each fold and class each part is found 1, 2 and 4 times."""

    def __init__(self, texts: list[list[str]], labels: np.ndarray, folds: np.ndarray):
        self.parts: dict[str, int] = {}
        known: dict[str, list[int]] = {}
        cells: list[dict[int, int]] = [{} for _ in range(2 * FOLDS * len(TIMES))]
        for words, label, fold in zip(texts, labels, folds):
            here: Counter[int] = Counter()
            for word, times in Counter(words).items():
                if word not in known:
                    known[word] = [self.parts.setdefault(p, len(self.parts)) for p in parts_of(word)]
                for part in known[word]:
                    here[part] += times
            for t, least in enumerate(TIMES):
                cell = cells[(2 * fold + label) * len(TIMES) + t]
                for part, times in here.items():
                    if times >= least:
                        cell[part] = cell.get(part, 0) + 1
        self.table = np.zeros((FOLDS, 2, len(TIMES), len(self.parts)), np.int32)
        for cell, row in zip(cells, self.table.reshape(len(cells), len(self.parts))):
            row[np.array(list(cell), np.int64)] = list(cell.values())
        self.sizes = np.zeros((FOLDS, 2), np.int64)
        np.add.at(self.sizes, (folds, labels), 1)

    def toxic_parts(self, folds: list[int]) -> set[str]:
        """The parts that toxic documents of these folds have significantly more often.

        The likelihood ratio is chi-squared; its bound keeps the probability of a single wrong part
        among all those tested below `ERROR`, whatever the other parts reach.
        """
        ordinary, toxic = self.table[folds].sum(0)
        sizes = np.maximum(1, self.sizes[folds].sum(0))
        tested = int((toxic > 0).sum())
        if not tested:
            return set()
        share = (toxic + ordinary) / sizes.sum()
        ratio = np.zeros(share.shape)
        for seen, size in ((ordinary, sizes[0]), (toxic, sizes[1])):
            for count, expected in ((seen, size * share), (size - seen, size * (1 - share))):
                some = count > 0
                ratio[some] += 2 * count[some] * np.log(count[some] / expected[some])
        ratio[toxic * sizes[0] <= ordinary * sizes[1]] = 0
        # The tail of a chi-squared value v with one degree of freedom is below exp(-v / 2).
        found = (ratio >= 2 * math.log(tested / ERROR)).any(axis=0)
        return {part for part, i in self.parts.items() if found[i]}


def _passages(words: list[str], marked: set[str]) -> bytes:
    """What the marked parts cover of the words, with blanks between."""
    found = []
    for word in words:
        starts = [i for i, part in enumerate(parts_of(word)) if part in marked]
        end = 0
        for i in starts:
            if i > end or not found:
                found.append(" ")
            found.append(f" {word} "[max(i, end) : i + PART])
            end = i + PART
    return letters("".join(found))


def _dictionaries(
    texts: list[list[str]], labels: np.ndarray, chosen: np.ndarray, marked: set[str]
) -> tuple[bytes, bytes]:
    toxic, ordinary = ([texts[i] for i in np.flatnonzero(chosen & (labels == k))] for k in (1, 0))
    passages = [_passages(words, marked) for words in toxic] if marked else []
    vocabularies = [letters(" ".join(sorted(set(words)))) for words in ordinary]
    return _dictionary([p for p in passages if p]), _dictionary([v for v in vocabularies if v])


def _evidence(words: np.ndarray, hits: np.ndarray, rates: tuple[float, float]) -> np.ndarray:
    """The log likelihood ratio of the toxic rate of hits to the ordinary one."""
    return hits * math.log(rates[1] / rates[0]) - words * (rates[1] - rates[0])


def _logistic(x: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Log odds as a line in `x`, by Newton's method with a weak pull to 0; it never falls."""
    design = np.stack([np.ones(len(x)), x], axis=1)
    line = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ line, -30, 30)))
        slope = design.T @ (weights * (labels - p)) - 0.01 * line
        curve = design.T @ (design * (weights * p * (1 - p))[:, None]) + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        line += np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(line[0]), max(0.0, float(line[1]))


def fit(rows: list[tuple[str, int]], sizes: tuple[int, int] | None = None) -> Model:
    """A model of labelled texts.

    Equal texts count once. Each fold of them is calibrated on dictionaries of the others; those of
    the model are of all. `sizes` are the numbers of ordinary and toxic documents that the texts
    stand for: a sample with its own share of toxic ones is weighted accordingly.
    """
    rows = list(dict.fromkeys(rows))
    texts = [words_of(text) for text, _ in rows]
    labels = np.array([label for _, label in rows], np.int64)
    folds = np.arange(len(rows)) % FOLDS
    if not labels.any():
        return Model(b"", b"", 1, (1.0, 1.0), (-math.inf, 0.0))
    counts = _Counts(texts, labels, folds)
    words = np.array([len(w) for w in texts], np.int64)
    saved = [np.zeros(0, np.int64)] * len(rows)
    for fold in range(FOLDS):
        others = [k for k in range(FOLDS) if k != fold]
        marked = counts.toxic_parts(others)
        savings = Savings(*_dictionaries(texts, labels, folds != fold, marked))
        for i in np.flatnonzero(folds == fold):
            saved[i] = np.array(savings(texts[i]) if marked else [], np.int64)
    here = np.maximum(1, np.bincount(labels, minlength=2))
    weights = np.array([size / n for size, n in zip(sizes or here, here)])[labels]
    weights *= len(labels) / max(weights.sum(), 1e-9)
    best = None
    for least in range(1, 2 + max(int(s.max(initial=0)) for s in saved)):
        hits = np.array([int((s >= least).sum()) for s in saved], np.int64)
        ordinary, toxic = (
            (hits[labels == k].sum() + 0.5) / (words[labels == k].sum() + 1000) for k in (0, 1)
        )
        rates = float(ordinary), float(max(toxic, ordinary))
        line = _logistic(_evidence(words, hits, rates), labels, weights)
        model = Model(b"", b"", least, rates, line)
        p = np.clip(model.scores(words, hits), 1e-9, 1 - 1e-9)
        loss = -(weights * np.log(np.where(labels == 1, p, 1 - p))).sum()
        if best is None or loss < best[0]:
            best = loss, model
    everything = counts.toxic_parts(list(range(FOLDS)))
    dictionaries = _dictionaries(texts, labels, np.ones(len(rows), bool), everything)
    return replace(best[1], toxic=dictionaries[0], ordinary=dictionaries[1])


def training_rows(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE
) -> tuple[list[tuple[str, int]], tuple[int, int]]:
    """At most `sample` labelled texts of each class, none of them held out, and the numbers of
    ordinary and toxic labels that they are taken from.

    They are those of the smallest hash of their id, so the choice does not depend on the order
    of the tables; texts above `LONGEST` bytes are left out. Only the chosen ids are sent to the
    documents. Of documents that repeat an id the least text is taken.
    """
    open_ = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != HELD_OUT
    usable = labels.filter(open_ & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = usable.filter("toxic = 1").orderBy(*order).limit(sample)
    chosen = chosen.union(usable.filter("toxic = 0").orderBy(*order).limit(sample))
    rows = docs.select("doc_id", text_of().alias("text")).filter(F.octet_length("text") <= LONGEST)
    rows = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic")
    found = rows.agg(F.min("text").alias("text")).collect()  # at most 2 * sample documents
    found.sort(key=lambda row: (zlib.crc32(f"half {row['doc_id']}".encode()), row["text"]))
    counts = {row["toxic"]: row["count"] for row in usable.groupBy("toxic").count().collect()}
    rows = [(row["text"], int(row["toxic"])) for row in found]
    return rows, (counts.get(0, 0), counts.get(1, 0))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `words`, `toxic_words` and `score` (0 to 1) of every row, by its whole text.

    `toxic_words` have a window that is nearer to toxic text. A null or empty text has no words;
    its score is what the shares of the labels say.
    """
    ship(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("words", T.LongType()),
            T.StructField("toxic_words", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        savings = Savings(model.toxic, model.ordinary)
        for batch in batches:
            for first, last in blocks(batch.column("size").to_numpy(), 8 << 20):
                part = batch.slice(first, last - first)
                words, hits = [], []
                for text in part.column("text").to_pylist():
                    saved = savings(words_of(text))
                    words.append(len(saved))
                    hits.append(sum(s >= model.saved for s in saved))
                scores = model.scores(np.array(words, np.int64), np.array(hits, np.int64))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "words": pa.array(words, pa.int64()),
                        "toxic_words": pa.array(hits, pa.int64()),
                        "score": pa.array(scores, pa.float64()),
                    }
                )

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.select("*", F.octet_length("text").alias("size")).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted`, `words` and `toxic_words` of every document.

    `held_out` says whether the label, if any, was kept from the model; false for a null id.
    Without labels every score is 0.
    """
    model = fit(*training_rows(docs, labels, sample))
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(rest == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= PREDICTED).cast("int").alias("predicted"),
        "words",
        "toxic_words",
    )
