"""Exact deduplication, decontamination and sharding."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickstream.llm import decontamination, exact_dedup, sharding
from clickstream.llm.common import text_of
from tests.llm import brute


def equal(df, **options):
    return exact_dedup.equal_contents(df, exact_dedup.without_blanks(text_of()), **options)


def test_equal_contents(docs, corpus):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in equal(docs(corpus)).collect()}
    groups = defaultdict(list)
    for i, text in enumerate(corpus):
        groups["".join(c for c in text if c not in " \t\n\v\f\r")].append((-len(text), i))
    expected = {}
    for members in groups.values():
        keep = min(members)[1]
        expected |= {i: (keep, len(members), i == keep) for _, i in members}
    assert got == expected


def test_hot_text_meets_in_salts(docs):
    texts = ["hot text"] * 500 + ["hottext ", "other"]
    got = equal(docs(texts), salts=4).collect()
    assert Counter((r.keep_id, r.group_size) for r in got) == {(0, 501): 500, (0, 501): 501, (501, 1): 1}


def test_colliding_digests_are_not_mixed_up(docs):
    def weak(content):
        return F.length(content).cast("string")

    with pytest.raises(Exception, match="two contents"):
        equal(docs(["ab", "cd"]), digest=weak, salts=1).collect()
    got = equal(docs(["ab", "a b", "cde"]), digest=weak).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(0, 1, 2), (1, 1, 2), (2, 2, 1)}


def test_exact_dedup_of_odd_rows(odd, docs):
    got = exact_dedup.exact_dedup(odd)
    assert got.columns == odd.columns
    # The winner of the empty texts is the row of id 0; a null id comes last.
    assert sorted((str(r.doc_id), (r.text or "")[:12]) for r in got.collect()) == sorted(
        [("0", ""), ("None", "some words o"), ("2", "the same row"), ("2", "the same row"),
         ("2", "another text"), ("3", "word word wo"), ("5", "\x00  \U0001f600")]
    )
    assert exact_dedup.exact_dedup(docs([])).count() == 0


BENCHMARK = "item_id long, text string"


def contaminated(spark, df, items, **options):
    found = decontamination.contamination(df, spark.createDataFrame(items, BENCHMARK), **options)
    digest = F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256)
    rows = found.select("doc_id", "n_words", "n_hit", F.size("items"), digest, "contaminated")
    return Counter(map(tuple, rows.collect()))


def test_contamination(spark, docs, corpus):
    words = corpus[3].split()
    longest = max(corpus, key=len).split()
    items = [
        (1, " ".join(longest[100:140])), (2, " ".join(longest[110:150]).upper()),
        (10, " ".join(words[:5])), (11, "x"), (12, "the of"), (13, "of and to"), (14, None),
        (15, "..."), (None, " ".join(longest[400:420])), (2, " ".join(longest[700:713])),
    ]
    expected = Counter(brute.contamination(list(enumerate(corpus)), items))
    assert sum(row[2] > 0 for row in expected) > 10
    assert contaminated(spark, docs(corpus), items) == expected
    # A set beyond the limit is broadcast in blocks.
    assert contaminated(spark, docs(corpus), items, limit=2000) == expected


def test_contamination_of_odd_rows(spark, odd, docs):
    from tests.llm.conftest import ODD

    items = [(1, "word " * 13), (2, "text without an id")]
    assert contaminated(spark, odd, items) == Counter(brute.contamination(ODD, items))
    assert contaminated(spark, odd, []) == Counter(brute.contamination(ODD, []))
    assert contaminated(spark, docs([]), items) == Counter()
    benchmark = spark.createDataFrame(items, BENCHMARK)
    kept = decontamination.without_contaminated(odd, benchmark)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "1", "1", "2", "2", "2", "5", "None"]


def test_spans_are_cut_out(spark, docs):
    df = docs(["One, two; three -- FOUR five.", "nothing here", None, "two three"])
    benchmark = spark.createDataFrame([(1, "two three four")], BENCHMARK)
    got = {r.doc_id: r.text for r in decontamination.without_spans(df, benchmark).collect()}
    assert got == {0: "One five.", 1: "nothing here", 2: None, 3: "two three"}


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_decreasing(seed):
    import random

    rng = random.Random(seed)
    sizes = [rng.randint(1, 100) for _ in range(300)]
    bins = sharding.best_fit_decreasing(sizes, 100)
    filled, expected = Counter(), []
    for size, bin_ in zip(sizes, bins):
        filled[bin_] += size
    assert max(filled.values()) <= 100
    # By the definition: the fullest bin that still has room, largest sizes first.
    for size in sorted(sizes, reverse=True):
        fits = [i for i, room in enumerate(expected) if room >= size]
        if fits:
            expected[min(fits, key=lambda i: (expected[i], i))] -= size
        else:
            expected.append(100 - size)
    assert sorted(100 - room for room in expected) == sorted(filled.values())


def test_shards(docs, corpus):
    texts = corpus * 3 + ["hot " * 20] * 100
    got = sharding.shard_documents(docs(texts)).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    shards = defaultdict(list)
    for r in got:
        assert r.size == len(texts[r.doc_id].encode()) + 1
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        shards[r.shard].append(r)
    for rows in shards.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    by_text = {}
    for r in got:
        assert by_text.setdefault(texts[r.doc_id], r.shard) == r.shard


def test_shards_of_equal_bytes(docs):
    texts = [f"{i} " * (i % 50 + 1) for i in range(2000)]
    got = sharding.shard_documents(docs(texts)).groupBy("shard").sum("size").collect()
    sizes = [r["sum(size)"] for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 16


def test_shards_of_odd_rows(odd, docs):
    got = sharding.shard_documents(odd).collect()
    assert len(got) == odd.count() and sharding.shard_documents(docs([])).count() == 0
    assert len({(r.shard, r.slot) for r in got}) == len(got)
