"""The registered queries on the small tables: against SQL, or against brute force."""

import os
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from clickstream.llm.oracle import ORACLE_SQL
from clickstream.llm.queries import QUERIES
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(tables):
    return tables.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def run(spark, name, *columns):
    return Counter(tuple(r) for r in QUERIES[name](spark, SF_DIR).select(*columns).collect())


def test_all_are_registered():
    names = {name.split("_")[0] for name in QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert entry.queries().keys() >= QUERIES.keys() | {"pipeline"}


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_against_sql(spark, tables, name):
    expected = tables.execute(ORACLE_SQL[name])
    columns = [column[0] for column in expected.description]
    assert sorted(columns) == sorted(QUERIES[name](spark, SF_DIR).columns)
    assert run(spark, name, *columns) == Counter(expected.fetchall())


def test_jaccard_join(spark, texts):
    expected = brute.near_documents(texts)
    assert run(spark, "op1_jaccard_join", "doc_id", "class_id", "n_links") == Counter(
        (i, texts[root][0], n) for (i, _), (root, n) in zip(texts, expected)
    )


def test_substrings(spark, texts):
    got = run(spark, "op3_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter((i, n, gone, d) for i, n, gone, _, d in brute.repeated_words(texts))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert run(spark, "op10_suffix_dedup", *columns) == Counter(brute.repeated_bytes(texts))


def test_decontamination(spark, tables, texts):
    items = tables.execute("SELECT item_id, text FROM benchmark").fetchall()
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = run(spark, "op6_decontamination", *columns)
    assert got == Counter(brute.contamination(texts, items)) and any(row[2] for row in got)


def test_languages(spark, tables):
    rows = QUERIES["op4_language_id"](spark, SF_DIR).collect()
    assert len(rows) == tables.execute("SELECT count(*) FROM pages").fetchone()[0]
    assert sum(r.language == r.declared and r.accepted for r in rows) >= 0.98 * len(rows)


def test_toxicity(spark, texts):
    rows = QUERIES["op8_toxicity"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in texts}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_toxicity_of_held_out_labels(spark):
    """In every language, though none is told; and ordinary documents are left alone."""
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    found = QUERIES["op8_toxicity"](spark, folder).filter("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    counted = found.join(labels, "doc_id").join(docs, "doc_id").groupBy("lang", "toxic")
    rows = counted.agg({"predicted": "sum", "doc_id": "count"}).collect()
    share = {(r["lang"], r["toxic"]): (r["sum(predicted)"], r["count(doc_id)"]) for r in rows}
    assert {lang for lang, _ in share} == {"en", "de", "fr", "es"}
    assert all(n >= 0.8 * of for (_, toxic), (n, of) in share.items() if toxic), share
    assert all(n <= 0.06 * of for (_, toxic), (n, of) in share.items() if not toxic), share


def test_pipeline(spark, texts, tables):
    """Each stage on what the one before kept, against the operators' own definitions."""
    from clickstream.llm.common import materialise, table

    docs = table(spark, SF_DIR, "documents")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialise(stage(spark, docs, SF_DIR), name)
        steps[name] = before, docs
        if name != "packing":
            assert docs.columns == before.columns
    pairs = {
        name: [[(r.doc_id, r.text) for r in df.orderBy("doc_id").collect()] for df in both]
        for name, both in steps.items()
        if name != "packing"
    }
    # Every text here is of a language.
    before, after = pairs["language_id"]
    assert after == [(i, t) for i, t in before if any(c.isalpha() for c in t)]
    # Lines stay in order, and no line with letters comes twice.
    before, after = map(dict, pairs["line_dedup"])
    seen = set()
    for i, text in sorted(after.items()):
        rest = iter(before[i].split("\n"))
        assert all(line in rest for line in text.split("\n"))
        letters = [line for line in text.split("\n") if any(c.isalnum() for c in line)]
        assert seen.isdisjoint(letters)
        seen.update(letters)
    before, after = pairs["jaccard_join"]
    near = brute.near_documents(before)
    assert [i for i, _ in after] == [before[k][0] for k in range(len(before)) if near[k][0] == k]
    before, after = pairs["decontamination"]
    items = tables.execute("SELECT item_id, text FROM benchmark").fetchall()
    bad = {row[0] for row in brute.contamination(before, items) if row[-1]}
    assert after == [(i, t) for i, t in before if i not in bad]
    kept, packed = steps["packing"]
    assert packed.select("doc_id").distinct().count() == kept.count()
    run = corpus_pipeline.run(spark, SF_DIR)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(*columns).collect())) == sorted(
        map(tuple, packed.select(*columns).collect())
    )


def test_pipeline_of_nothing(spark, odd, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs([]), SF_DIR).count() == 0
        assert stage(spark, odd, SF_DIR).columns == odd.columns
