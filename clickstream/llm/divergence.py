"""How the vocabulary of each source departs from its language and from the other sources.

Single-pass in-memory indexing: a task builds postings (group, term, occurrences, documents) in
memory until a block is full, then emits the block as a run sorted by term and cut into hash
shards of terms. One task per shard merges all runs by a heap into the frequencies of its terms.
Each of these passes on, in the same order, what every source has of a term.

The divergence of two sources sums over all terms of the language. What two sources that lack a
term add is the same for each such term, so it is one product per pair; the frequencies are
streamed once for what differs from it: corrections by the occurrences of one source alone, from a
histogram, and corrections where both have the term, summed in a matrix of a block of sources.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from decimal import Decimal
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickstream.llm.common import materialise, partitions, ship

BLOCK_POSTINGS = 1_000_000  # that a task holds in memory
PIECE_BYTES = 1 << 20  # of a text whose terms are listed at a time
LEAST_DOCUMENTS = 3  # of a language that must have a kept term
TERMS = 200  # reported per group
SOURCES = 256  # of a language in a block of the matrix
PAIRS = 1 << 20  # posting pairs corrected at a time
SCALE = 1_000_000_000

# Bytes that terms are made of, A-Z becoming a-z; all others separate.
_TERM_BYTES = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
_LOWER = bytes(b | 0x20 if b < 0x80 else b for b in _TERM_BYTES)
_FOLD = bytes(_LOWER[_TERM_BYTES.index(b)] if b in _TERM_BYTES else 0x20 for b in range(256))
_SPACE = re.compile(b" ")


def _pieces(text: str, size: int) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    data = text.encode().translate(_FOLD)
    at = 0
    while at < len(data):
        found = _SPACE.search(data, min(len(data), at + size))
        end = found.start() if found else len(data)
        yield data[at:end].split()
        at = end


class _Block:
    """Postings of the documents since the last run."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = {}
        self.documents: dict[str, Counter] = {}  # by language
        self.postings = 0

    def add(self, lang: str, source: str, text: str, size: int) -> None:
        counts = self.counts.setdefault((lang, source), Counter())
        before, own = len(counts), set()
        for terms in _pieces(text, size):
            counts.update(terms)
            own.update(terms)
        self.documents.setdefault(lang, Counter()).update(own)
        self.postings += len(counts) - before

    def run(self, shards: int) -> Iterator[pa.RecordBatch]:
        """Rows of a language and shard: its terms in order and the postings of each."""
        for lang, documents in self.documents.items():
            terms, seed = sorted(documents), crc32(lang.encode())
            # The place of each term among those of all shards, shard by shard.
            shard = np.array([crc32(term, seed) % shards for term in terms], np.int32)
            by_shard = np.argsort(shard, kind="stable")
            place = np.empty(len(terms), np.int64)
            place[by_shard] = np.arange(len(terms))
            place_of = dict(zip(terms, place.tolist()))
            groups = [(s, c) for (of, s), c in self.counts.items() if of == lang]
            sizes = [len(counts) for _, counts in groups]
            at, number = np.empty(sum(sizes), np.int64), np.empty(sum(sizes), np.int64)
            since = 0
            for (_, counts), size in zip(groups, sizes):
                found = map(place_of.__getitem__, counts)
                at[since : since + size] = np.fromiter(found, np.int64, size)
                number[since : since + size] = np.fromiter(counts.values(), np.int64, size)
                since += size
            order = np.argsort(at, kind="stable")
            each = np.bincount(at, minlength=len(terms))
            source = np.repeat(np.arange(len(groups)), sizes)[order]
            shards_here, first = np.unique(shard[by_shard], return_index=True)
            first = np.append(first, len(terms))
            upto = np.concatenate([[0], np.cumsum(each)])[first]
            of_terms = [
                pa.array(terms, pa.binary()).take(pa.array(by_shard)),
                pa.array(np.array([documents[t] for t in terms], np.int64)[by_shard]),
                pa.array(each.astype(np.int32)),
            ]
            names = pa.array([name for name, _ in groups], pa.string())
            of_postings = [names.take(pa.array(source)), pa.array(number[order])]
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                for offsets, columns in ((first, of_terms), (upto, of_postings))
                for values in columns
            ]
            langs = pa.array([lang] * len(shards_here), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(shards_here), langs, *lists], _RUN_NAMES)


_RUN = (
    "shard int, lang string, terms array<binary>, documents array<long>, sizes array<int>, "
    "sources array<string>, counts array<long>"
)
_RUN_NAMES = [column.split()[0] for column in _RUN.split(", ")]


def _runs(shards: int, postings: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            columns = [batch.column(name) for name in ("lang", "source", "text")]
            for lang, source, text in zip(*columns):
                block.add(lang.as_py(), source.as_py(), text.as_py(), size)
                if block.postings >= postings:
                    yield from block.run(shards)
                    block = _Block()
        if block.postings:
            yield from block.run(shards)

    return run


def _segment(batch: pa.RecordBatch, row: int) -> Iterator[tuple]:
    """The terms of a run's row in order, each with its postings; some are decoded at a time."""
    lists = [batch.column(name)[row].values for name in _RUN_NAMES[2:]]
    at = 0
    for first in range(0, len(lists[0]), 1024):
        terms, documents, sizes = (v.slice(first, 1024).to_pylist() for v in lists[:3])
        whole = sum(sizes)
        sources, counts = (values.slice(at, whole).to_pylist() for values in lists[3:])
        stops = list(itertools.accumulate(sizes))
        at += whole
        for term, of, low, high in zip(terms, documents, [0, *stops], stops):
            yield term, of, sources[low:high], counts[low:high]


_FREQUENCIES = "lang string, term string, whole long, sources array<string>, counts array<long>"


def _merged(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The task has one shard.
        segments: dict[str, list] = {}
        for batch in batches:
            for row, lang in enumerate(batch.column("lang").to_pylist()):
                segments.setdefault(lang, []).append(_segment(batch, row))
        out = _Kept()
        for lang, runs in segments.items():
            current, documents, sources, counts = None, 0, [], []
            for term, of, some, number in heapq.merge(*runs):
                if term == current:  # of another run
                    documents += of
                    sources += some
                    counts += number
                    continue
                if documents >= least:
                    out.add(lang, current, sources, counts)
                    if len(out.langs) >= 10_000:
                        yield out.taken()
                current, documents, sources, counts = term, of, some, number
            if documents >= least:
                out.add(lang, current, sources, counts)
        if out.langs:
            yield out.taken()

    return run


class _Kept:
    """Merged terms, as columns."""

    def __init__(self):
        self.langs, self.terms, self.wholes, self.ends = [], [], [], [0]
        self.sources, self.counts = [], []

    def add(self, lang: str, term: bytes, sources: list[str], counts: list[int]) -> None:
        if len(set(sources)) < len(sources):
            sums: dict[str, int] = {}
            for source, count in zip(sources, counts):
                sums[source] = sums.get(source, 0) + count
            sources, counts = list(sums), list(sums.values())
        self.langs.append(lang)
        self.terms.append(term)
        self.wholes.append(sum(counts))
        self.sources += sources
        self.counts += counts
        self.ends.append(len(self.counts))

    def taken(self) -> pa.RecordBatch:
        ends = pa.array(self.ends, pa.int32())
        arrays = [
            pa.array(self.langs, pa.string()),
            pa.array(self.terms, pa.binary()).cast(pa.string()),
            pa.array(self.wholes, pa.int64()),
            pa.ListArray.from_arrays(ends, pa.array(self.sources, pa.string())),
            pa.ListArray.from_arrays(ends, pa.array(self.counts, pa.int64())),
        ]
        self.__init__()
        return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _FREQUENCIES.split(", ")])


def _groups_of(docs: DataFrame) -> DataFrame:
    empty = F.lit("")
    return docs.select(
        *[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")]
    )


def frequencies(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """A row for each kept `term` of each `lang`: its occurrences there (`whole`), the `sources`
    that have it and how often each does (`counts`).

    Terms are runs of letters, A-Z in lower case, and of all characters beyond ASCII. A language
    keeps those of at least `least` of its documents; every row is a document, also one that
    repeats another. Null text, lang and source count as empty.
    """
    ship(docs.sparkSession)
    shards = partitions(docs.sparkSession)
    runs = _groups_of(docs).mapInArrow(_runs(shards, BLOCK_POSTINGS, PIECE_BYTES), _RUN)
    merged = runs.repartitionById(shards, "shard").mapInArrow(_merged(least), _FREQUENCIES)
    return materialise(merged, "frequencies")


def postings(found: DataFrame) -> DataFrame:
    """`lang`, `term`, `whole`, `source` and `count` of each source that has a kept term."""
    rows = found.select("lang", "term", "whole", F.explode(F.arrays_zip("sources", "counts")))
    return rows.select(
        "lang", "term", "whole", F.col("col.sources").alias("source"), F.col("col.counts").alias("count")
    )


def groups(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Every `lang` and `source` that occurs, in order: `number` from 0 within the language and
    `sources` there, `total` occurrences of kept terms, those of the language (`lang_total`) and its
    number of kept terms (`terms`)."""
    of_lang = found.groupBy("lang").agg(
        F.sum("whole").alias("lang_total"), F.count(F.lit(1)).alias("terms")
    )
    of_group = postings(found).groupBy("lang", "source").agg(F.sum("count").alias("total"))
    every = _groups_of(docs).select("lang", "source").distinct()
    in_lang = Window.partitionBy("lang")
    return materialise(
        every.join(of_group, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .na.fill(0, ["total", "lang_total", "terms"])
        .withColumn("number", F.row_number().over(in_lang.orderBy("source")) - 1)
        .withColumn("sources", F.count(F.lit(1)).over(in_lang)),
        "groups",
    )


def _p(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)); null where nothing is kept."""
    return F.expr(
        f"1 + CAST({SCALE} AS DECIMAL(10)) * CAST({count} + 1 AS DECIMAL(20)) "
        f"div nullif(CAST({total} + terms AS DECIMAL(20)), 0)"
    )


def _f(p: str, q: str) -> str:
    """floor((p - q) ** 2 / q): the departure of p from q."""
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _small(found: DataFrame, limit: int = 100_000) -> DataFrame:
    """To be broadcast, if it has at most `limit` rows, which is checked."""
    return F.broadcast(found) if found.count() <= limit else found


def _ranked(values: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return values.select(
        "lang",
        "source",
        F.lit(part).alias("part"),
        "item",
        "value",
        F.row_number().over(order).alias("rank"),
    )


def leading_terms(found: DataFrame, every: DataFrame, limit: int = TERMS) -> DataFrame:
    """The terms that are more probable in a group than in its language, by how much they depart."""
    values = (
        postings(found)
        .join(_small(every.drop("number", "sources")), ["lang", "source"])
        .withColumn("p", _p("count", "total"))
        .withColumn("q", _p("whole", "lang_total"))
        .filter("p > q")
        .select("lang", "source", F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    )
    return _ranked(values, "term").filter(F.col("rank") <= limit)


def _both(width: int, pairs: int):
    """Corrections where two sources have the same term, summed by pair of sources."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, key = None, None
        for part_key, part in _by_key(_whole_terms(batches)):
            if part_key != key:
                if sums is not None:
                    yield _summed(key, sums, width)
                sums, key = np.zeros((2, 2 * width, 2 * width), np.int64), part_key
            _correct(part, part_key, sums, width, pairs)
        if sums is not None:
            yield _summed(key, sums, width)

    return run


_KEY = ["lang", "low", "high", "term"]


def _whole_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows, sorted by `_KEY`, in tables that hold all rows of a term."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        starts = _changes(table, _KEY)
        cut = int(starts[-1]) if len(starts) else 0
        yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None:
        yield rest


def _changes(table: pa.Table, names: list[str]) -> np.ndarray:
    """Where rows begin that differ from the one before in any of the columns."""
    if not table.num_rows:
        return np.zeros(0, np.int64)
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for name in names:
        column = table[name].combine_chunks()
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _by_key(tables: Iterator[pa.Table]) -> Iterator[tuple[tuple, pa.Table]]:
    for table in tables:
        starts = _changes(table, _KEY[:3]).tolist()
        for first, stop in zip(starts, [*starts[1:], table.num_rows]):
            part = table.slice(first, stop - first)
            row = part.slice(0, 1).to_pylist()[0]
            yield (row["lang"], row["low"], row["high"]), part


def _departures(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _correct(table: pa.Table, key: tuple, sums: np.ndarray, width: int, pairs: int) -> None:
    starts = _changes(table, ["term"])
    sizes = np.diff(np.append(starts, table.num_rows))
    number, p, p0 = (table[name].to_numpy() for name in ("number", "p", "p0"))
    _, low, high = key
    place = number - np.where(number // width == low, low, high - 1) * width
    upto = np.cumsum(sizes**2)
    first = 0
    while first < len(sizes):  # as many terms at a time as have `pairs` pairs, or one
        before = upto[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(upto, before + pairs, "right")))
        each = np.repeat(sizes[first:stop], sizes[first:stop])
        i = np.repeat(np.arange(starts[first], starts[first] + len(each)), each)
        begins = np.repeat(np.repeat(starts[first:stop], sizes[first:stop]), each)
        ends = np.cumsum(each)
        j = np.arange(len(i)) - np.repeat(ends - each, each) + begins
        other = i != j
        if low != high:
            other &= (number[i] // width) != (number[j] // width)
        i, j = i[other], j[other]
        value = _departures(p[i], p[j]) - _departures(p[i], p0[j])
        value += _departures(p0[i], p0[j]) - _departures(p0[i], p[j])
        # In two halves, as the sums may be larger than 64 bits.
        np.add.at(sums[0], (place[i], place[j]), value >> 32)
        np.add.at(sums[1], (place[i], place[j]), value & 0xFFFFFFFF)
        first = stop


def _summed(key: tuple, sums: np.ndarray, width: int) -> pa.RecordBatch:
    lang, low, high = key
    i, j = np.nonzero(sums.any(axis=0))
    values = [Decimal((int(a) << 32) + int(b)) for a, b in zip(sums[0][i, j], sums[1][i, j])]
    real = [k + np.where(k < width, low, high - 1) * width for k in (i, j)]
    return pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([lang] * len(i), pa.string()),
            "one": pa.array(real[0], pa.int32()),
            "other": pa.array(real[1], pa.int32()),
            "value": pa.array(values, pa.decimal128(38, 0)),
        }
    )


def source_pairs(found: DataFrame, every: DataFrame) -> DataFrame:
    """How far each source departs from each other of its language, over all kept terms.

    Pairs of sources, which the result consists of, are made once per language; what the terms add
    is summed before it meets them.
    """
    session = every.sparkSession
    every = every.withColumn("p0", _p("0", "total"))
    other = every.select(
        "lang", F.col("source").alias("item"), F.col("number").alias("of"), F.col("p0").alias("q0")
    )
    few = _small(other)
    distinct = F.col("number") != F.col("of")
    # If no source had any term.
    base = every.join(few, "lang").filter(distinct)
    base = base.select(
        "lang", "number", "of", F.expr(f"CAST(terms AS DECIMAL(20)) * {_f('p0', 'q0')}").alias("value")
    )
    # Where one of the two has the term: by how many of its terms are how probable.
    known = postings(found).join(_small(every), ["lang", "source"])
    known = known.withColumn("p", _p("count", "total"))
    alike = known.groupBy("lang", "number", "p", "p0").agg(F.count(F.lit(1)).alias("n"))
    forth = f"CAST(n AS DECIMAL(20)) * ({_f('p', 'q0')} - {_f('p0', 'q0')})"
    back = f"CAST(n AS DECIMAL(20)) * ({_f('q0', 'p')} - {_f('q0', 'p0')})"
    single = alike.join(few, "lang").filter(distinct)
    single = single.groupBy("lang", "number", "of").agg(
        F.sum(F.expr(forth)).alias("forth"), F.sum(F.expr(back)).alias("back")
    )
    single = single.select(
        "lang",
        F.expr("stack(2, number, of, forth, of, number, back) AS (number, of, value)"),
    )
    # Where both have it: in blocks of sources, so that the sums of a block fit into memory.
    block = F.floor(F.col("number") / SOURCES).cast("int")
    blocks = F.ceil(F.col("sources") / SOURCES).cast("int")
    placed = known.select(
        "lang", "term", "number", "p", "p0", block.alias("block"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("with"),
    ).select(
        "lang", "term", "number", "p", "p0",
        F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"),
    )
    both = (
        placed.repartition(partitions(session), *_KEY)
        .sortWithinPartitions(*_KEY)
        .mapInArrow(_both(SOURCES, PAIRS), "lang string, one int, other int, value decimal(38,0)")
        .withColumnsRenamed({"one": "number", "other": "of"})
    )
    parts = [base, single, both]
    parts = [p.select("lang", "number", "of", F.col("value").cast("decimal(38,0)")) for p in parts]
    values = parts[0].unionByName(parts[1]).unionByName(parts[2])
    values = values.groupBy("lang", "number", "of").agg(F.sum("value").alias("value"))
    names = _small(every.select("lang", "number", "source"))
    items = _small(other.select("lang", "of", "item"))
    value = F.coalesce("value", F.lit(0)).cast("long").alias("value")
    named = values.join(names, ["lang", "number"]).join(items, ["lang", "of"])
    return _ranked(named.select("lang", "source", "item", value), "pair")


def source_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, limit: int = TERMS) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value` and `rank` of every group.

    p of a term is 1 + floor(10**9 * (count + 1) / (N + V)), with N occurrences of the V kept
    terms. Part `pair` has every other source of the language and the sum over all kept terms of
    floor((p - q)**2 / q), q being the other's; it is 0 if none is kept. Part `term` has the first
    `limit` terms of the group that are more probable in it than in its language. Equal values
    are ranked by item. A group without terms is one like any other; an empty table has no rows.
    """
    found = frequencies(docs, least)
    every = groups(docs, found)
    return source_pairs(found, every).unionByName(leading_terms(found, every, limit))
