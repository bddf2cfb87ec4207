"""Winnowing against a plain rewrite."""

import hashlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from clickstream.llm import fingerprints as fp


def grams(text):
    """The 52-bit signed hash of every gram."""
    parts = [text[i : i + fp.GRAM] for i in range(max(1, len(text) - fp.GRAM + 1))] if text else []
    found = [xxhash.xxh64_intdigest(part.encode(), seed=42) for part in parts]
    return [(h - (1 << 64) if h >> 63 else h) >> 12 for h in found]


def winnowed(text):
    found = grams(text)
    kept = []
    for start in range(max(1, len(found) - fp.WINDOW + 1)) if found else []:
        window = found[start : start + fp.WINDOW]
        least = min(window)
        place = start + max(i for i, h in enumerate(window) if h == least)
        if (place, least) not in kept[-1:]:
            kept.append((place, least))
    return kept


def likeness(one, other):
    one, other = {h for _, h in one}, {h for _, h in other}
    return len(one & other) / len(one | other) if one | other else 1.0


def listed(found):
    return " ".join(f"{(h >> 20) & 0xFFFFFFFF:08x}" for _, h in found)


def expected(rows):
    """What `edited_fingerprints` gives for (id, text) rows; repeated rows are one document."""
    key = lambda r: xxhash.xxh64_intdigest(r[1].encode(), seed=42)
    documents = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is None, r[0] or 0, key(r)))
    out = {}
    for at, (i, text) in enumerate(documents):
        after = documents[(at + 1) % len(documents)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed = winnowed(text), winnowed(edited)
        out[i, text] = (
            i,
            len(text),
            hashlib.sha256(edited.encode()).hexdigest(),
            listed(own),
            listed(changed),
            likeness(own, changed),
            likeness(own, winnowed(after)),
        )
    return [out[i, t or ""] for i, t in rows]


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
           "near_next"]


def got(df):
    return Counter(tuple(r) for r in fp.edited_fingerprints(df).select(*COLUMNS).collect())


TEXTS = [
    "", "x", "short text", "a" * 300, "ab" * 40, "exactly sixteen.", "a text of just 47 code points, one window big.",
    "\U0001f600a" * 3000, "first half / second half " * 30, "nul \x00 and \r\n ends\n" * 9, "ÄÖÜ " * 2000,
]


@pytest.mark.parametrize("size", [46, 47, 48, 2093, 2094, 2095, 2096, 4141, 4142, 4143, 9000])
def test_positions_and_ties(spark, corpus, size):
    long = "".join(corpus)[:size]
    tied = ("abcabcabd" * size)[:size]
    df = spark.createDataFrame([(t,) for t in (long, tied)], "text string")
    rows = df.select(fp.winnowed(F.col("text"))).collect()
    assert [[(e.position, e.hash) for e in r[0]] for r in rows] == [winnowed(long), winnowed(tied)]


def test_what_full_windows_within_a_length_keep(spark, corpus):
    """At every length, those at which a window or a gram begins or ends among them."""
    long = max(corpus, key=len)[:260]
    rows = [(text, n) for text in (long, "abcabcabd" * 29, "a" * 260) for n in range(len(text) + 1)]
    df = spark.createDataFrame(rows, "text string, n int").withColumn("found", fp.winnowed(F.col("text")))
    found = df.select("text", "n", fp._within(F.col("found"), F.col("n")).alias("kept")).collect()
    for r in found:
        full = r.n >= fp.GRAM + fp.WINDOW - 1
        assert [(e.position, e.hash) for e in r.kept] == (winnowed(r.text[: r.n]) if full else [])
    assert len(found) > 700


def test_against_plain_rewrite(spark, docs, corpus):
    rows = list(enumerate(TEXTS + corpus))
    assert got(docs(rows)) == Counter(expected(rows))
    backwards = [(9 * (len(rows) - i), t) for i, t in rows]
    assert got(docs(backwards)) == Counter(expected(backwards))


def test_every_shared_run_is_found(spark, corpus):
    run = fp.GRAM + fp.WINDOW - 1
    text = max(corpus, key=len)
    parts = ["before it " * 9 + text[at : at + run] + " and after" * 9 for at in range(100, 9000, 97)]
    df = spark.createDataFrame([(t,) for t in [text, *parts]], "text string")
    found = [{e.hash: e.position for e in r[0]} for r in df.select(fp.winnowed(F.col("text"))).collect()]
    for one in found[1:]:
        assert any(90 <= one[h] <= 90 + run - fp.GRAM for h in one.keys() & found[0].keys())


def test_odd_rows(odd, docs, spark):
    found = fp.edited_fingerprints(odd).collect()
    assert len(found) == odd.count()
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert Counter((r.doc_id, r.n_chars) for r in found) == Counter((i, len(t or "")) for i, t in rows)
    assert fp.edited_fingerprints(docs([])).count() == 0
    lone = fp.edited_fingerprints(docs([(None, "one text " * 20)])).collect()
    assert len(lone) == 1 and lone[0].near_next == 1.0
    assert fp.fingerprints(odd).count() == odd.count()
