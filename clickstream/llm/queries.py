"""The operators of this subpackage as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickstream.llm import (
    alignment,
    decontamination,
    divergence,
    exact_dedup,
    fingerprints,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    sharding,
    substring_dedup,
    suffix_dedup,
    toxicity,
)
from clickstream.llm.common import table, text_of

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def op1_jaccard_join(spark, sf_dir):
    found = jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copy_id", "n_links")


def op2_exact_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    content = exact_dedup.without_blanks(text_of())
    return exact_dedup.equal_contents(docs, content).withColumnRenamed("digest", "text_sha256")


def op3_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = substring_dedup.repeated_words(docs, text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.select(F.col("lang").alias("language"), "text"))
    return language_id.identify(language_id.of_pages(table(spark, sf_dir, "pages")), model)


def op5_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, ids=False)


def op6_decontamination(spark, sf_dir):
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    items = F.encode(F.array_join("items", ","), "UTF-8")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        "contaminated",
    )


def op7_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_marks(docs).select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        "removed",
    )


def op10_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = suffix_dedup.repeated_bytes(docs, text=False)
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", n_spans, "kept_sha256")


def op11_divergence(spark, sf_dir):
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_alignment(spark, sf_dir):
    return alignment.link_strengths(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


def op13_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_language_id": op4_language_id,
    "op5_packing": op5_packing,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_divergence": op11_divergence,
    "op12_alignment": op12_alignment,
    "op13_fingerprints": op13_fingerprints,
}
