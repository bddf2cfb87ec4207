"""Language identification by Bayesian fusion of text, declared language and address.

The posterior of a language is proportional to the likelihood of the text (byte trigrams), that
of the declared language, and a prior of the host. Hosts with few pages know little of their own:
their prior is drawn towards that of the address suffix, and this towards that of all rows. All
counts come from grouped aggregation over all rows, weighted by what the text alone says; a row's
own share is taken out of its host's counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from clickstream.llm.common import materialise, row_key, rows_without, ship, text_of
from clickstream.llm.hashing import blocks

BITS = 14  # of a trigram's bucket
LANGUAGES = 200  # at most, which bounds the model that every task gets
EVIDENCE = 50  # trigrams that a text counts for at most: neighbours are not independent
STRENGTH = 10.0  # rows that the wider level counts for in a host's or suffix's prior
CONFIDENCE = 0.5  # least posterior of an accepted row


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_likelihood: np.ndarray  # by bucket and language


def _letters() -> np.ndarray:
    """What each byte counts as: letters in lower case, anything else in ASCII a space."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 0x20
    letters = np.arange(ord("a"), ord("z") + 1)
    table[letters] = table[letters - 32] = letters
    return table


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all trigrams, text by text, and where each text's begin and the last ends.

    Every text is framed by spaces, and runs of what is not a letter are one space. A text without
    letters has no trigrams.
    """
    data = np.frombuffer(b" " + b"  ".join(texts) + b" ", np.uint8)
    sizes = np.array([len(text) + 2 for text in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    letters = _letters()[data]
    space = letters == 0x20
    kept = np.ones(len(letters), bool)
    kept[1:] = ~(space[1:] & space[:-1])
    kept[starts] = True
    at = np.concatenate([[0], np.cumsum(kept)])
    letters = letters[kept].astype(np.uint32)
    grams = letters[:-2] << np.uint32(16) | letters[1:-1] << np.uint32(8) | letters[2:]
    buckets = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    # A trigram belongs to the text that all of its letters are from.
    begins, ends = at[starts], at[starts + sizes] - 2
    inside = np.zeros(len(letters) + 1, np.int64)
    full = ends > begins
    np.add.at(inside, begins[full], 1)
    np.add.at(inside, ends[full], -1)
    own = np.cumsum(inside)[: len(buckets)] > 0
    upto = np.concatenate([[0], np.cumsum(own)])
    first = upto[np.minimum(begins, len(own))]
    return buckets[own], np.append(first, upto[-1])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each bucket occurs in the task's texts of each language."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for first, last in blocks(batch.column("size").to_numpy()):
            part = batch.slice(first, last - first)
            languages = part.column("language").to_pylist()
            texts = [text.encode() for text in part.column("text").to_pylist()]
            for language in set(languages):
                own = [t for t, name in zip(texts, languages) if name == language]
                found = np.bincount(trigrams(own)[0], minlength=1 << BITS)
                counts[language] = counts.get(language, 0) + found
    for language, found in counts.items():
        bucket = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict(
            {
                "language": pa.array([language] * len(bucket), pa.string()),
                "bucket": pa.array(bucket, pa.int32()),
                "count": pa.array(found[bucket], pa.int64()),
            }
        )


def train(rows: DataFrame) -> Model:
    """The text model of all rows with a `language`; `text` is read whole.

    Each task sums its counts before the shuffle, and the model has a fixed number of buckets per
    language, so it does not grow with the rows.
    """
    ship(rows.sparkSession)
    usable = rows.filter("language IS NOT NULL").select("language", text_of().alias("text"))
    usable = usable.withColumn("size", F.octet_length("text"))
    counts = usable.mapInArrow(_counted, "language string, bucket int, count long")
    counts = counts.groupBy("language", "bucket").agg(F.sum("count").alias("count"))
    counts = materialise(counts, "trigrams")
    languages = counts.select("language").distinct().orderBy("language").limit(LANGUAGES + 1)
    names = [row["language"] for row in languages.collect()]
    if len(names) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    table = np.zeros((1 << BITS, len(names)))
    for row in counts.collect():  # at most 2**BITS * LANGUAGES rows
        table[row["bucket"], names.index(row["language"])] = row["count"]
    total = table.sum(axis=0)
    return Model(tuple(names), np.log((table + 0.5) / (total + 0.5 * len(table))))


def _scored(model: Model):
    """The evidence of each text, as log-likelihoods and as probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(model.languages)
        table = model.log_likelihood.astype(np.float32)
        for batch in batches:
            for first, last in blocks(batch.column("size").to_numpy()):
                part = batch.slice(first, last - first)
                buckets, at = trigrams([t.encode() for t in part.column("text").to_pylist()])
                number = np.diff(at)
                has = np.flatnonzero(number)
                sums = np.zeros((len(number), width))
                if len(has) and width:
                    sums[has] = np.add.reduceat(
                        table[buckets], at[:-1][has], axis=0, dtype=np.float64
                    )
                weight = np.minimum(number, EVIDENCE) / np.maximum(number, 1)
                sums *= weight[:, None]
                share = np.exp(sums - sums.max(axis=1, keepdims=True, initial=-np.inf))
                share /= share.sum(axis=1, keepdims=True)
                names = [name for name in part.schema.names if name not in ("text", "size")]
                columns = {name: part.column(name) for name in names}
                columns["trigrams"] = pa.array(number, pa.int64())
                for name, values in (("evidence", sums), ("share", share)):
                    columns[name] = pa.array(list(values), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _sums(width: int) -> list[Column]:
    return [F.sum(F.get("share", F.lit(i))).alias(f"c{i}") for i in range(width)]


def _array(names: list[Column]) -> Column:
    return F.array(*names)


def identify(rows: DataFrame, model: Model, strength: float = STRENGTH) -> DataFrame:
    """Adds `language`, `posterior`, `text_language`, `trigrams` and `accepted`; `text` goes.

    `rows` has `text`, `declared` (language code), `suffix` and `host`, all of which may be null:
    what is missing is no evidence. Without a model the language is null. Ties go to the language
    that comes first in the alphabet. A row is accepted if its text has letters and the posterior
    reaches `CONFIDENCE`.
    """
    ship(rows.sparkSession)
    width = len(model.languages)
    if not width:
        nothing = F.lit(None).cast("string")
        return rows.drop("text").select(
            "*", nothing.alias("language"), F.lit(None).cast("double").alias("posterior"),
            nothing.alias("text_language"), F.lit(0).cast("long").alias("trigrams"),
            F.lit(False).alias("accepted"),
        )
    names = F.array(*[F.lit(name) for name in model.languages])
    sized = rows.withColumn("text", text_of()).withColumn("size", F.octet_length("text"))
    numbers = T.ArrayType(T.DoubleType())
    schema = T.StructType(
        [
            *rows.drop("text").schema.fields,
            T.StructField("trigrams", T.LongType()),
            T.StructField("evidence", numbers),
            T.StructField("share", numbers),
        ]
    )
    scored = materialise(
        sized.select(*rows.drop("text").columns, "text", "size").mapInArrow(_scored(model), schema),
        "language-evidence",
    )
    known = scored.filter("trigrams > 0")
    columns = [F.col(f"c{i}") for i in range(width)]

    # Priors: of all rows, of each suffix, of each host.
    hosts = known.filter("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.first("suffix").alias("suffix"), *_sums(width)
    )
    hosts = materialise(hosts, "hosts")
    total = known.agg(F.count(F.lit(1)).alias("n"), *_sums(width)).first()
    all_ = [((total[f"c{i}"] or 0) + 1) / (total["n"] + width) for i in range(width)]
    suffixes = hosts.groupBy("suffix").agg(
        F.sum("n").alias("n"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(width)]
    )
    suffixes = materialise(
        suffixes.select(
            "suffix",
            _array(
                [(c + strength * p) / (F.col("n") + strength) for c, p in zip(columns, all_)]
            ).alias("suffix_prior"),
        ),
        "suffixes",
    )
    hosts = hosts.select("host", F.col("n").alias("host_n"), _array(columns).alias("host_counts"))

    # How rows of a language declare it.
    declared = known.filter("declared IS NOT NULL").groupBy("declared").agg(*_sums(width))
    declared = materialise(declared, "declared")
    sums = declared.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(width)]
    ).first()
    kinds = max(1, sums["n"])
    declared = declared.select(
        "declared",
        _array(
            [
                F.log((c + 1 / kinds) / ((sums[f"c{i}"] or 0) + 1))
                for i, c in enumerate(columns)
            ]
        ).alias("declaration"),
    )

    joined = (
        scored.join(materialise(hosts, "host-priors"), "host", "left")
        .join(suffixes, "suffix", "left")
        .join(declared, "declared", "left")
    )
    wide = F.coalesce("suffix_prior", F.array(*[F.lit(p) for p in all_]))
    counted = F.col("trigrams") > 0

    def log_posterior(i: int) -> Column:
        own = F.when(counted, F.get("share", F.lit(i))).otherwise(0.0)
        others = F.greatest(F.lit(0.0), F.get("host_counts", F.lit(i)) - own)
        rows_ = F.col("host_n") - counted.cast("int")
        prior = F.when(
            F.col("host_n").isNotNull(),
            (others + strength * F.get(wide, F.lit(i))) / (rows_ + strength),
        ).otherwise(F.get(wide, F.lit(i)))
        said = F.coalesce(F.get("declaration", F.lit(i)), F.lit(0.0))
        return F.log(prior) + F.get("evidence", F.lit(i)) + said

    logs = joined.withColumn("logs", _array([log_posterior(i) for i in range(width)]))
    best = F.array_max("logs")
    mass = F.aggregate("logs", F.lit(0.0), lambda sum_, x: sum_ + F.exp(x - best))

    def first(of: Column) -> Column:
        return F.get(names, (F.array_position(of, F.array_max(of)) - 1).cast("int"))

    return logs.select(
        *rows.drop("text").columns,
        first(F.col("logs")).alias("language"),
        (1 / mass).alias("posterior"),
        F.when(counted, first(F.col("share"))).alias("text_language"),
        "trigrams",
        (counted & (1 / mass >= CONFIDENCE)).alias("accepted"),
    )


def of_pages(pages: DataFrame) -> DataFrame:
    """The evidence of web pages: `page_id`, `text`, `declared`, `suffix` and `host`.

    A page declares its language by the `lang` attribute of its html element, of which the first
    subtag counts. The text is what is left without scripts, styles, comments and tags.
    """
    html = F.coalesce("html", F.lit(""))
    address = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"
    host = F.lower(F.regexp_extract("url", address, 1))
    code = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    markup = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
    empty_is_null = lambda c: F.when(c != "", c)
    return pages.select(
        "page_id",
        F.regexp_replace(html, markup, " ").alias("text"),
        empty_is_null(code).alias("declared"),
        empty_is_null(F.regexp_extract(host, r"\.([^.]+)\.?$", 1)).alias("suffix"),
        empty_is_null(host).alias("host"),
    )


def of_documents(docs: DataFrame) -> DataFrame:
    """The evidence of documents: `lang` is what they declare, and `source` their host."""
    return docs.select(
        "doc_id", row_key().alias("row"), "text",
        F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"),
        F.col("source").alias("host"),
    )


def identified_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents whose language is accepted, with all their columns.

    The text model is trained on the declared languages of all documents.
    """
    model = train(docs.select(F.col("lang").alias("language"), "text"))
    return rows_without(docs, identify(of_documents(docs), model, **options).filter("NOT accepted"))
