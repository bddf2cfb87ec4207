"""Source divergence against its SQL and against plain arithmetic."""

from collections import Counter

import duckdb
import pytest

from clickstream.llm import divergence
from clickstream.llm.oracle import ORACLE_SQL

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def by_sql(df):
    documents = df.select("doc_id", "text", "lang", "source").toArrow()  # noqa: F841
    found = duckdb.sql(ORACLE_SQL["op11_divergence"])
    return Counter(found.select(*[duckdb.ColumnExpression(c) for c in COLUMNS]).fetchall())


def got(df, **options):
    found = divergence.source_divergence(df, **options)
    assert found.columns == COLUMNS and [t for _, t in found.dtypes][-2:] == ["bigint", "int"]
    return Counter(tuple(r) for r in found.collect())


@pytest.fixture
def sources(spark, corpus):
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 7}") for i, t in enumerate(corpus)]
    rows += [(900 + i, t, lang, source) for i, (t, lang, source) in enumerate([
        (None, None, None), ("", "en", "nothing"), ("12 34 !!", "fr", "a"), ("", "fr", "b"),
        ("École école ÉCOLE", None, "s1"), ("école Zwölf", "", "s2"), ("école", "", None),
        ("once only words", "it", "x"), ("ties ties", "nl", "a"), ("ties", "nl", "b"), ("TIES", "nl", "c"),
    ])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("block, postings, pairs", [(256, 400_000, 1 << 20), (2, 50, 7)])
def test_against_sql(sources, monkeypatch, block, postings, pairs):
    """Also with blocks of few sources and postings, so that all ways are taken."""
    monkeypatch.setattr(divergence, "SOURCES", block)
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", postings)
    monkeypatch.setattr(divergence, "PAIRS", pairs)
    monkeypatch.setattr(divergence, "PIECE_BYTES", 64 if block == 2 else 1 << 20)
    assert got(sources) == by_sql(sources)


def test_small_numbers(spark):
    rows = [(i, "b a" if i else "a", "en", "x" if i < 3 else "y") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    # x has a three times and b twice, y each once, of two kept terms.
    p = {("x", "a"): 571428572, ("x", "b"): 428571429, ("y", "a"): 500000001, ("y", "b"): 500000001}
    f = lambda a, b: (a - b) ** 2 // b
    pairs = {
        (a, b): sum(f(p[a, t], p[b, t]) for t in "ab") for a, b in (("x", "y"), ("y", "x"))
    }
    found = got(df)
    assert {(r[1], r[3]): r[4] for r in found if r[2] == "pair"} == pairs
    assert [r[3] for r in found if r[2] == "term" and r[1] == "x"] == ["a"]


def test_odd_rows(odd, docs):
    assert got(odd) == by_sql(odd)
    assert got(docs([])) == Counter()
