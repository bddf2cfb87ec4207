"""Exact deduplication: salted groups of equal content, combined in three steps.

Rows of equal content meet in one group however many there are, so a text that a third of all
rows repeat must not travel to one task row by row. Each task first folds its own copies (the
partial aggregation), the copies of a text are then merged in `salts` groups, and the winners of
those groups are combined at last. Every step groups by the digest *and the whole content*; the
digest alone only joins the result back to the rows, after a check that no digest stands for two
contents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickstream.llm.common import BLANK, materialise, text_of

SALTS = 16  # groups per digest; a bit of a long each, so at most 63


def without_blanks(text: Column) -> Column:
    """The text without any blank, tab or line break."""
    return F.regexp_replace(text, BLANK + "+", "")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def equal_contents(
    docs: DataFrame,
    content: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    digest=sha256,
    salts: int = SALTS,
) -> DataFrame:
    """`doc_id`, `digest`, `keep_id`, `group_size` and `kept` of every row.

    Rows are equal if `content` is. Of equal rows the one with the longest text (in code points)
    stays, then the one with the smallest id; a null id comes after all others. A null text
    counts as empty. Rows that repeat id, content and length of the one that stays cannot be told
    apart from it and are marked kept as well. Two contents of one digest end the job with an
    error instead of being mixed up.
    """
    if not 1 <= salts <= 63:
        raise ValueError("salts must be between 1 and 63")
    salt = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(salts)).cast("int")
    order = F.struct(
        (-F.char_length(text_of(text))).alias("shorter"),
        F.col(doc_id).isNull().alias("no_id"),
        F.col(doc_id).alias("id"),
    )
    rows = docs.select(
        digest(content).alias("digest"), salt.alias("salt"), content.alias("content"),
        order.alias("order"),
    )
    merged = rows.groupBy("digest", "salt", "content").agg(
        F.min("order").alias("order"), F.count(F.lit(1)).alias("rows")
    )
    winners = merged.groupBy("digest", "content").agg(
        F.min("order").alias("order"),
        F.sum("rows").alias("group_size"),
        F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts"),
    )
    # What is left of a content: its winner, its size and the salts under which its rows are.
    present = F.filter(
        F.sequence(F.lit(0), F.lit(salts - 1)), lambda s: F.getbit(F.col("salts"), s) == 1
    )
    groups = (
        materialise(winners.drop("content"), "winners")
        .withColumn("salt", F.explode(present))
        .groupBy("digest", "salt")
        .agg(
            F.count(F.lit(1)).alias("contents"),
            F.first("order").alias("order"),
            F.first("group_size").alias("group_size"),
        )
    )
    keys = docs.select(
        F.col(doc_id).alias("doc_id"), digest(content).alias("digest"), salt.alias("salt"),
        F.char_length(text_of(text)).alias("length"),
    )
    wins = F.col("doc_id").eqNullSafe(F.col("order.id")) & (
        -F.col("length") == F.col("order.shorter")
    )
    return keys.join(groups, ["digest", "salt"]).select(
        "doc_id",
        "digest",
        F.when(F.col("contents") == 1, F.col("order.id"))
        .otherwise(F.raise_error(F.lit("two contents share one digest")))
        .alias("keep_id"),
        "group_size",
        wins.alias("kept"),
    )


def exact_dedup(docs: DataFrame, content: Column | None = None, **options) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    doc_id = options.get("doc_id", "doc_id")
    text = options.get("text", "text")
    content = without_blanks(text_of(text)) if content is None else content
    kept = equal_contents(docs, content, **options).filter("kept").select("doc_id", "digest")
    kept = kept.distinct()
    digest = options.get("digest", sha256)(content)
    same = docs[doc_id].eqNullSafe(kept["doc_id"]) & (digest == kept["digest"])
    return docs.join(kept, same, "left_semi")
