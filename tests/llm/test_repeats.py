"""Substring deduplication over words and bytes."""

from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from clickstream.llm import substring_dedup, suffix_dedup
from clickstream.llm.repeats import Unit, winnow
from tests.llm import brute


def words(df, **options):
    found = substring_dedup.repeated_words(df, **options).collect()
    return Counter((r.doc_id, r.n_words, r.n_removed, len(r.spans), r.kept_sha256) for r in found)


def bytes_(df, **options):
    found = suffix_dedup.repeated_bytes(df, **options).collect()
    return Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found)


def test_words_against_brute_force(docs, corpus):
    expected = Counter(brute.repeated_words(list(enumerate(corpus))))
    assert sum(row[2] for row in expected) > 300
    assert words(docs(corpus)) == expected
    assert words(docs(corpus).repartition(7)) == expected


def test_bytes_against_brute_force(docs, corpus):
    texts = [t[:3000] for t in corpus]
    expected = Counter(brute.repeated_bytes(list(enumerate(texts))))
    assert sum(row[2] for row in expected) > 300
    assert bytes_(docs(texts).repartition(7)) == expected


@pytest.mark.parametrize("run, find", [(words, brute.repeated_words), (bytes_, brute.repeated_bytes)])
def test_odd_rows(odd, docs, run, find):
    from tests.llm.conftest import ODD

    assert run(odd) == Counter(find(ODD))
    assert run(docs([])) == Counter()
    assert run(docs([None, ""])) == Counter(find([(0, None), (1, "")]))


def test_few_symbols_and_short_windows(docs):
    texts = ["ab" * 40, "aab" * 30, "b" * 90 + "ab" * 20, "a" * 100]
    assert bytes_(docs(texts), window=9, seed=3) == Counter(
        brute.repeated_bytes(list(enumerate(texts)), 9)
    )
    spaced = [" ".join(t) for t in texts]
    assert words(docs(spaced), window=6, seed=2) == Counter(
        brute.repeated_words(list(enumerate(spaced)), 6)
    )


@pytest.mark.parametrize("window", [140, 141, 177, 200, 300, 1000])
def test_wide_windows(docs, corpus, window):
    """Anchors that share more windows than fit a byte, in long repeats and in repeated symbols."""
    texts = [t[:3000] for t in corpus[:12]]
    texts += [texts[0][100:1500] + texts[1][:1200], "x" * 700 + texts[2][:1300], "ab" * 900, "ab" * 800]
    expected = Counter(brute.repeated_bytes(list(enumerate(texts)), window))
    assert sum(row[2] for row in expected) > 1000
    assert bytes_(docs(texts), window=window) == expected
    spaced = [" ".join(t[:1500]) for t in texts]
    found = Counter(brute.repeated_words(list(enumerate(spaced)), window))
    assert words(docs(spaced), window=window) == found


def test_impossible_windows(docs):
    for window, seed in ((5, 6), (40_000, 9), (5, 0)):
        with pytest.raises(ValueError):
            Unit("bytes", window, seed)


def test_contexts_meet_by_all_bits_of_their_hash():
    """Contexts of one anchor whose hashes agree in 32 bits only are no repeats."""
    import numpy as np
    import pyarrow as pa

    from clickstream.llm.repeats import _by_bucket, _meet

    low = {name: np.zeros(2, np.int64) for name in ("row", "lo", "left", "right")}
    for other, repeats in ((5 | 1 << 40, 0), (5, 1)):
        record = low | {
            "anchor": np.array([7, 7], np.uint64),
            "context": np.array([5, other], np.uint64),
            "doc": np.array([1, 2]),
            "count": np.array([3, 3]),
        }
        batch = _by_bucket(record, np.zeros(2, np.int64), np.zeros(2, bool), 1)
        found = _meet(pa.Table.from_batches([batch]))
        assert sum(w == 0 for w in found.column("wanted").to_pylist()) == repeats


@pytest.mark.parametrize("run, find", [(words, brute.repeated_words), (bytes_, brute.repeated_bytes)])
def test_many_rows_of_one_id(docs, run, find):
    """2,000 rows without an id, of different texts and lengths, some with an earlier passage."""
    passage = " ".join(f"w{i}" for i in range(15))
    rows = [(0, passage)]
    rows += [(None, f"a{i} b{i} " * (i % 9) + (passage if i % 2 else f"c{i}")) for i in range(2000)]
    assert run(docs(rows)) == Counter(find(rows))


def test_spans_and_text(docs):
    passage = " ".join(f"w{i}" for i in range(15))
    df = docs(["a b " + passage, "c " + passage + "  d\te", passage])
    got = {r.doc_id: (r.kept, [tuple(s) for s in r.spans]) for r in substring_dedup.repeated_words(df).collect()}
    assert got == {0: ("a b " + passage, []), 1: ("c d e", [(1, 16)]), 2: ("", [(0, 15)])}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=0, max_size=60), st.integers(1, 4))
def test_every_window_is_in_one_context(symbols, texts):
    """The contexts cover each window of each text just once, and share its anchor."""
    import numpy as np

    from clickstream.llm.hashing import byte_sums

    unit = Unit("bytes", 6, 2)
    ends = np.linspace(0, len(symbols), texts + 1).astype(np.int64)
    found = winnow(unit, byte_sums(np.array(symbols, np.uint8)), ends)
    seen = Counter()
    for text, lo, count in zip(found["text"], found["lo"], found["count"]):
        seen.update((text, at) for at in range(lo, lo + count))
    sizes = np.diff(ends)
    assert seen == Counter((t, at) for t, n in enumerate(sizes) for at in range(max(0, n - 5)))
    assert all(found["count"] <= unit.reach)
