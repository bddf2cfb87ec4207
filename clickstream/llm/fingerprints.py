"""Document fingerprints by winnowing, in Spark's own functions.

Every run of `GRAM` code points is hashed; of each `WINDOW` consecutive hashes the smallest is kept
with its position, the rightmost of equal ones. So any two texts that share a run of
`GRAM + WINDOW - 1` code points share a kept hash, and the positions say where. A text too short
for a full window has the smallest of the hashes that it has; one too short for a gram is one
gram; an empty text has no fingerprint.

A window is judged by its own hashes alone, so a text is taken in pieces of some thousand windows
and never held as hashes whole; and what the windows within a part of a text keep can be told from
the positions, which is how `spliced` makes the fingerprint of a text put together from two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickstream.llm.common import materialise, partitions, row_key, text_of

GRAM = 16  # code points
WINDOW = 32  # grams: a power of 2
PIECE = 2048  # windows taken at a time
PLACE = (1 << 12) - 1  # low bits of a packed hash, which hold the place within a piece


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, the value being computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _every(text: Column, pattern: str) -> Column:
    """The first group of every match."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _packed(piece: Column) -> Column:
    """Of each gram its hash above its place, later places first, so that the least of some is the
    rightmost of their smallest hashes."""
    grams = F.when(
        F.char_length(piece) >= GRAM, _every(piece, f"(?s)(?=(.{{{GRAM}}}))."),
    ).otherwise(F.array(piece))
    return F.transform(
        grams,
        lambda gram, place: F.xxhash64(gram).bitwiseOR(F.lit(PLACE)) - place,
    )


def _least(packed: Column) -> Column:
    """The least of each `WINDOW` consecutive values; the last ones reach over fewer."""

    def wider(have: int, reach: int) -> Callable[[Column], Column]:
        def least(values: Column, value: Column, i: Column) -> Column:
            return F.least(value, *[F.get(values, i + have * n) for n in range(1, reach)])

        return lambda values: F.transform(values, lambda value, i: least(values, value, i))

    have = 1
    while have < WINDOW:
        reach = 4 if have * 4 <= WINDOW else 2
        packed = _let(packed, wider(have, reach))
        have *= reach
    return packed


def winnowed(text: Column, whole: Column | None = None) -> Column:
    """The kept hashes of a text without nulls: an array of `position` (of the gram's first code
    point, from 0) and `hash` (52 bits, signed), by position.

    Where `whole` is false the text is part of a longer one, and only full windows count.
    """
    span = GRAM + WINDOW - 2  # code points beside the first that the windows of a start reach
    pieces = _every(text, f"(?s)(?=(.{{1,{PIECE + span}}})).{{1,{PIECE}}}")
    short = F.lit(True) if whole is None else whole

    def kept(piece: Column, number: Column) -> Column:
        windows = F.char_length(piece) - span
        alone = F.when((number == 0) & short, 1).otherwise(0)
        count = F.least(F.greatest(windows, alone), F.lit(PIECE))
        found = F.when(
            count > 0,
            F.array_distinct(F.slice(_least(_packed(piece)), F.lit(1), F.greatest(count, F.lit(1)))),
        ).otherwise(F.array().cast("array<long>"))
        place = lambda value: F.lit(PLACE) - value.bitwiseAND(F.lit(PLACE))
        return F.transform(
            found,
            lambda value: F.struct(
                (number * PIECE + place(value)).cast("long").alias("position"),
                F.shiftright(value, 12).alias("hash"),
            ),
        )

    return _once(F.flatten(F.transform(pieces, kept)))


def _once(found: Column) -> Column:
    """What two neighbouring stretches of windows keep alike stands once: it is side by side."""

    def first(entries: Column) -> Column:
        return F.filter(
            entries,
            lambda e, i: (i == 0) | (e["position"] != F.get(entries, i - 1)["position"]),
        )

    return _let(found, first)


def _within(found: Column, length: Column) -> Column:
    """What the full windows within the first `length` code points keep.

    A hash is first kept by the window that it ends, if it is no larger than the one before, or by
    the first that the one before is no longer in.
    """

    def end(entry: Column, i: Column) -> Column:
        before = F.get(found, i - 1)
        return (
            F.when(i == 0, F.lit(WINDOW - 1).cast("long"))
            .when(entry["hash"] <= before["hash"], entry["position"])
            .otherwise(before["position"] + WINDOW)
        )

    def ends(last: Column) -> Callable[[Column, Column], Column]:
        # That window ends less than a window behind the hash, and not before it: few are so near
        # to the last gram that it must be found.
        return lambda entry, i: F.when(entry["position"] <= last - WINDOW, True).otherwise(
            (entry["position"] <= last) & (end(entry, i) <= last)
        )

    # The last gram's position is computed once, not for each entry.
    return _let(length - GRAM, lambda last: F.filter(found, ends(last)))


def spliced(
    text: Column, found: Column, head: Column, other: Column, other_found: Column, tail: Column
) -> Column:
    """`winnowed` of the first `head` code points of `text` and then the first `tail` of `other`,
    from `winnowed` of both; only the windows across the seam are hashed."""
    span = GRAM + WINDOW - 2
    before, after = F.least(head, F.lit(span)), F.least(tail, F.lit(span))
    seam = F.concat(
        F.substring(text, head - before + 1, before), F.substring(other, F.lit(1), after)
    )
    whole = (before == head) & (after == tail)

    def moved(entries: Column, by: Column) -> Column:
        return F.transform(
            entries,
            lambda e: F.struct((e["position"] + by).alias("position"), e["hash"].alias("hash")),
        )

    return _once(
        F.concat(
            _within(found, head),
            moved(winnowed(seam, whole), head - before),
            moved(_within(other_found, tail), head),
        )
    )


def hashes(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda entry: entry["hash"]))


def likeness(one: Column, other: Column) -> Column:
    """The share of common hashes in all that either has, from 0 to 1; 1 if neither has any."""
    common, every = F.array_intersect(one, other), F.array_union(one, other)
    return F.coalesce(F.try_divide(F.size(common), F.size(every)), F.lit(1.0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_chars` and `fingerprint` (see `winnowed`) of each row; a null text is empty."""
    return docs.select(
        "doc_id",
        F.char_length(text_of()).cast("long").alias("n_chars"),
        winnowed(text_of()).alias("fingerprint"),
    )


SHARES = 8  # shares of consecutive ids for each shuffle partition


def _order() -> list[Column]:
    return [F.col("doc_id").asc_nulls_last(), F.col("row").asc()]


def _shares(rows: DataFrame) -> list[tuple[int | None, int]]:
    """The first `doc_id` and `row` of each share of consecutive rows, about equally many each.

    The list is as long as there are shares, a fixed number for each shuffle partition.
    """
    number = SHARES * partitions(rows.sparkSession)
    ids = rows.select("doc_id", "row").distinct().repartitionByRange(number, *_order())
    ids = materialise(ids.withColumn("share", F.spark_partition_id()), "ids")
    firsts = ids.withColumn("n", F.row_number().over(Window.partitionBy("share").orderBy(*_order())))
    firsts = firsts.filter("n = 1").orderBy("share").select("doc_id", "row")
    return [(first["doc_id"], first["row"]) for first in firsts.collect()]


def _array(values: list, of: str) -> Column:
    return F.expr(f"CAST(array({', '.join(map(str, values))}) AS array<{of}>)")


def _placed(rows: DataFrame, firsts: list[tuple[int | None, int]]) -> DataFrame:
    """Adds `share` to each row, and to each share the first row of the one after it as `guest`."""
    firsts = firsts or [(None, 0)]
    largest = (1 << 63) - 1  # stands for a null id beside the mark that it is one
    nulls = _array([i is None for i, _ in firsts], "boolean")
    ids = _array([largest if i is None else i for i, _ in firsts], "bigint")
    keys = _array([row for _, row in firsts], "bigint")
    own = F.struct(
        F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(largest)), "row"
    )

    def first(share: Column) -> Column:
        return F.struct(F.get(nulls, share), F.get(ids, share), F.get(keys, share))

    def halved(among: Column, _) -> Column:
        middle = F.floor((among["low"] + among["high"] + 1) / 2).cast("int")
        reached = first(middle) <= own
        return F.struct(
            F.when(reached, middle).otherwise(among["low"]).alias("low"),
            F.when(reached, among["high"]).otherwise(middle - 1).alias("high"),
        )

    share = F.aggregate(
        F.sequence(F.lit(0), F.lit(len(firsts).bit_length())),
        F.struct(F.lit(0).alias("low"), F.lit(len(firsts) - 1).alias("high")),
        lambda among, step: F.when(among["low"] < among["high"], halved(among, step)).otherwise(among),
        lambda among: among["low"],
    )
    before = F.pmod(F.col("share") - 1, F.lit(len(firsts)))
    here = F.struct(F.col("share").alias("share"), F.lit(False).alias("guest"))
    there = F.struct(before.alias("share"), F.lit(True).alias("guest"))
    places = F.when(first(F.col("share")) == own, F.array(here, there)).otherwise(F.array(here))
    return (
        rows.withColumn("share", share)
        .withColumn("place", F.explode(places))
        .select(*rows.columns, "place.share", "place.guest")
    )


def with_next(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: `doc_id`, `text`, `found` (see `winnowed`), and `next_text` and
    `next_found` of the next document by ascending id, the first being next to the last.

    A null text is empty. Rows without an id come last, and rows of one id are in the order of a
    hash of their text. Rows that repeat id and text are folded within the task first: they count
    as one document, whose result comes as often. A lone document is next to itself.
    """
    rows = docs.select("doc_id", text_of().alias("text"), row_key().alias("row"))
    folded = rows.groupBy("doc_id", "row").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")
    )
    number = partitions(docs.sparkSession)
    shares = _placed(folded, _shares(rows)).repartition(number, "share")
    hashed = shares.withColumn("found", winnowed(F.col("text")))
    following = F.struct(F.col("text").alias("next_text"), F.col("found").alias("next_found"))
    order = Window.partitionBy("share").orderBy("guest", *_order())
    return (
        hashed.withColumn("following", F.lead(following).over(order))
        .filter(~F.col("guest"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("doc_id", "text", "found", "following.*")
    )


def _listed(found: Column) -> Column:
    """The hashes in order of position, 8 hexadecimal digits each."""
    first = lambda entry: F.shiftright(entry["hash"], 20).bitwiseAND(F.lit(0xFFFFFFFF))
    digits = F.transform(found, lambda entry: F.lpad(F.hex(first(entry)), 8, "0"))
    return F.lower(F.array_join(digits, " "))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and how alike they and the next one's are.

    The edited text has the first half of the text, the middle code point included, and then as
    many code points of the next document (see `with_next`) as the other half had, or all.
    `doc_id`, `n_chars`, `edited_sha256`, `fingerprint` and `edited_fingerprint` (the first 32 bits
    of each kept hash, by position), `near_edited` and `near_next` (see `likeness`).
    """
    rows = with_next(docs).withColumn("n_chars", F.char_length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumns(
        {"head": F.col("n_chars") - half, "tail": F.least(half, F.char_length("next_text"))}
    )
    head, tail = F.col("head"), F.col("tail")
    edited = F.concat(
        F.substring("text", F.lit(1), head), F.substring("next_text", F.lit(1), tail)
    )
    columns = [F.col(c) for c in ("text", "found", "next_text", "next_found")]
    edited_found = spliced(columns[0], columns[1], head, columns[2], columns[3], tail)
    own = hashes(F.col("found"))
    return (
        rows.withColumns({"edited_found": edited_found, "own": own})
        .select(
            "doc_id",
            F.col("n_chars").cast("long").alias("n_chars"),
            F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
            _listed(F.col("found")).alias("fingerprint"),
            _listed(F.col("edited_found")).alias("edited_fingerprint"),
            likeness(F.col("own"), hashes(F.col("edited_found"))).alias("near_edited"),
            likeness(F.col("own"), hashes(F.col("next_found"))).alias("near_next"),
        )
    )
