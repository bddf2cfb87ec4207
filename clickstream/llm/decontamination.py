"""Benchmark decontamination: word windows of test items, looked up in the training documents.

The distinct windows of the items are a broadcast hash set, keyed by the hash of their first
words. Every position of every document is probed; a match of the hash is verified word by word.
Benchmarks do not grow with the corpus, but their size is checked all the same: above
`BROADCAST_BYTES` the set is split into blocks that are broadcast one after the other.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from clickstream.llm.common import (
    found_rows,
    materialise,
    own_columns,
    row_key,
    rows_without,
    same_row,
)

WINDOW = 13  # words
PIECE = 32  # words
BROADCAST_BYTES = 64 << 20
# What separates words, once A-Z are lower case, and the same before that.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of letters, digits and characters beyond ASCII, A-Z in lower case."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATOR), "")


def _seed(length: Column) -> Column:
    """How many first words of a window are hashed: 4, or 2 or 1 of a shorter one."""
    return F.when(length >= 4, 4).when(length >= 2, 2).otherwise(1)


def _hash(words: Column, at: Column, count: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(count)])


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The distinct windows of the items: `window`, `length`, `seed`, `hash` and `items`.

    An item of fewer words is one window; one without words has none. The ids of `items` are
    strings; a null id counts as an empty one.
    """
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    windows = (
        benchmark.select(item.alias("item"), words_of(F.col("text")).alias("words"))
        .withColumn("length", length)
        .filter("length > 0")
        .withColumn("start", F.explode(starts))
        .select("item", "length", F.slice("words", F.col("start"), F.col("length")).alias("window"))
        .groupBy("window", "length")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("seed", _seed(F.col("length")))
    )
    hashes = F.lit(None).cast("long")
    for seed in (1, 2, 4):
        hashes = F.when(F.col("seed") == seed, _hash(F.col("window"), F.lit(0), seed)).otherwise(
            hashes
        )
    return windows.withColumn("hash", hashes)


def _pieces(docs: DataFrame, window: int) -> DataFrame:
    """The words of each document in overlapping pieces, in each of which `PIECE` windows start.

    What is exploded to a row per position carries a copy of its words: those of a short piece,
    not those of the whole document.
    """
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(PIECE)),
        lambda start: F.struct(
            start.alias("start"),
            F.slice(F.col("words"), start + 1, F.lit(PIECE + window - 1)).alias("words"),
        ),
    )
    return docs.select(
        "doc_id", "row", F.size("words").alias("n_words"), F.explode(pieces).alias("piece")
    ).select("doc_id", "row", "n_words", "piece.start", "piece.words")


def _hits(pieces: DataFrame, windows: DataFrame, seed: int, marked: bool) -> DataFrame:
    """A row per verified occurrence, and if `marked` one more per document.

    Nothing is shuffled: a position that matches no window is dropped within the scan.
    """
    last = F.least(F.size("words") - seed, F.lit(PIECE - 1))
    seeds = F.transform(F.sequence(F.lit(0), last), lambda i: _hash(F.col("words"), i, seed))
    nothing = F.array().cast("array<long>")
    seeds = F.when(last >= 0, seeds).otherwise(nothing)
    first = (F.col("start") == 0) if marked else F.lit(False)
    mark = F.when(first, F.array(F.lit(None).cast("long"))).otherwise(nothing)
    positions = (
        pieces.withColumn("seeds", F.concat(mark, seeds))
        .withColumn("marks", first.cast("int"))
        .select("doc_id", "row", "n_words", "start", "marks", "words",
                F.posexplode("seeds").alias("at", "hash"))
    )
    at = F.col("at") - F.col("marks")
    found = windows.filter(F.col("seed") == seed).select("hash", "window", "length", "items")
    here = F.slice(F.col("words"), at + 1, F.col("length")) == F.col("window")
    same = (positions["hash"] == found["hash"]) & here
    rows = positions.join(F.broadcast(found), same, "left" if marked else "inner")
    is_mark, is_hit = at < 0, F.col("length").isNotNull()
    span = F.struct(
        (F.col("start") + at).alias("start"), (F.col("start") + at + F.col("length")).alias("end")
    )
    return rows.filter(is_mark | is_hit).select(
        "doc_id",
        "row",
        F.when(is_mark, F.col("n_words")).alias("n_words"),
        F.when(is_hit, span).alias("span"),
        "items",
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """What of each document occurs in the benchmark.

    Per row of `docs`: `doc_id`, `row` (see `row_key`), `n_words`, `spans` (sorted word ranges of
    occurring windows, `start` to before `end`), `n_hit` (words within any), `items` (sorted ids)
    and `contaminated` (at least a twentieth of the words, and one). A null text has no words.
    """
    windows = materialise(item_windows(benchmark, window), "windows")
    size = windows.agg(
        F.sum(F.octet_length(F.concat_ws(" ", "window", "items")) + 100), F.collect_set("seed")
    ).first()
    blocks, seeds = -(-(size[0] or 0) // limit) or 1, sorted(size[1], reverse=True) or [4]
    rows = docs.select(
        "doc_id", row_key().alias("row"), words_of(F.col("text")).alias("words")
    )
    pieces = _pieces(rows, window)
    parts = [
        _hits(pieces, windows.filter(F.pmod("hash", F.lit(blocks)) == block), seed, marked=first)
        for block in range(blocks)
        for seed in seeds
        for first in [block == 0 and seed == seeds[0]]
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    per_row = found.groupBy("doc_id", "row").agg(
        F.count("n_words").alias("rows"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    # Spans are sorted, so each adds what lies beyond the furthest end so far.
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")),
        lambda sum_, span: F.struct(
            F.greatest(sum_["end"], span["end"]).alias("end"),
            (
                sum_["hit"]
                + F.greatest(F.lit(0), span["end"] - F.greatest(span["start"], sum_["end"]))
            ).alias("hit"),
        ),
        lambda sum_: sum_["hit"].cast("long"),
    )
    return (
        per_row.withColumn("n_hit", covered)
        .withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .drop("copy", "rows")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    return rows_without(docs, contamination(docs, benchmark, **options).filter("contaminated"))


def without_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All documents; words within an occurring window are cut out of `text`.

    What separates words stays, once for each kept word; documents without a hit are unchanged.
    """
    hit = contamination(docs, benchmark, **options).filter("n_hit > 0")
    hit = found_rows(hit, "spans").distinct()
    text, spans = docs["text"], hit["spans"]
    words = F.array_remove(F.split(text, RAW_SEPARATOR), "")
    gaps = F.split(text, RAW_WORD)
    inside = lambda i: F.exists(spans, lambda s: (s["start"] <= i) & (i < s["end"]))
    kept = F.transform(
        words,
        lambda word, i: F.when(inside(i), F.lit("")).otherwise(F.concat(F.get(gaps, i), word)),
    )
    cut = F.concat(F.array_join(kept, ""), F.get(gaps, F.size(words)))
    joined = docs.join(hit, same_row(docs, hit), "left")
    return joined.select(
        *[
            F.when(spans.isNull(), text).otherwise(cut).alias("text") if name == "text" else column
            for name, column in zip(docs.columns, own_columns(docs))
        ]
    )
