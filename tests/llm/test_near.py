"""Jaccard join, fuzzy lines and connected components."""

import random

import numpy as np
import pytest

from clickstream.llm import jaccard_join, line_dedup
from clickstream.llm.common import materialise_alone
from clickstream.llm.components import components
from tests.llm import brute


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in range(40)],
        "star": [(17, i) for i in range(40)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)],
        "none": [],
    }[kind]
    got = components(spark.createDataFrame(links, "a long, b long").repartition(3))
    expected = brute.groups([(a, b) for a, b in links if a != b])
    assert {r.node: r.root for r in got.collect()} == expected


def test_jaccard_join(docs, corpus):
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(docs(corpus)).collect()}
    expected = brute.near_documents(list(enumerate(corpus)))
    assert got == dict(enumerate(expected)) and sum(n > 0 for _, n in expected) > 20


def test_large_group_is_compared_in_blocks(docs, monkeypatch):
    """More near copies than a block has; links between blocks are found and counted."""
    monkeypatch.setattr(jaccard_join, "CELL", 7)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(40):
        copy = list(base)
        copy[rng.randrange(200)] = f"x{i}"
        texts.append(" ".join(copy))
    texts += ["quite another text that has nothing to do with them"] * 3
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(docs(texts)).collect()}
    assert got == dict(enumerate(brute.near_documents(list(enumerate(texts)))))


def test_prefixes_are_shortened_to_the_recall():
    lengths = jaccard_join.prefix_lengths(0.8, 20, 8, 0.9995)
    missed = np.prod([1 - 0.8**n for n in lengths])
    assert missed <= 0.0005
    longer = sorted(lengths)
    longer[0] += 1  # any longer prefix would fall short
    assert np.prod([1 - 0.8**n for n in longer]) > 0.0005
    with pytest.raises(ValueError):
        jaccard_join.prefix_lengths(0.1, 2, 8, 0.9995)


def test_jaccard_of_odd_rows(odd, docs):
    got = sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in jaccard_join.jaccard_join(odd).collect())
    assert got == sorted([
        ("0", "0", 0), ("1", "1", 0), ("1", "1", 0), ("None", "None", 0), ("None", "None", 0),
        ("2", "2", 1), ("2", "2", 1), ("2", "2", 0), ("3", "3", 1), ("4", "3", 1), ("5", "5", 0),
    ])
    kept = jaccard_join.one_of_each_group(odd)
    assert kept.columns == odd.columns
    # Rows that repeat id and text are one and the same, and stay.
    assert kept.count() == odd.count() - 1
    assert jaccard_join.jaccard_join(docs([])).count() == 0


def near_lines(texts):
    """Kept lines by the definition: SimHash and edit distance of all pairs of different lines."""
    import re

    places = {}
    for i, text in enumerate(texts):
        for at, raw in enumerate((text or "").split("\n")):
            line = re.sub(r"[^\w]+|_", " ", raw.lower())
            line = " ".join(line.split())
            if line:
                places.setdefault(line, []).append((i, at))
    return places


def test_line_dedup(spark, docs):
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(300)]
    lines = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(30)]
    near = []
    for line in lines[:15]:
        copy = line.split()
        copy[rng.randrange(60)] = "changed"
        near.append(" ".join(copy))
    texts = ["\n".join(rng.sample(lines + near + ["Same, line!", "same LINE", "", "--"], 12)) for _ in range(25)]
    df = docs(texts)
    sims = {
        r.line: r.sim
        for r in line_dedup.simhashes(line_dedup._folded(line_dedup._lines(df)))
        .join(line_dedup._folded(line_dedup._lines(df)), ["h1", "h2"])
        .select("sim", "first.line")
        .collect()
    }
    places = near_lines(texts)
    assert sims.keys() == places.keys()
    links = []
    for a in places:
        for b in places:
            bits = (sims[a] ^ sims[b]).bit_count()
            if a < b and bits <= line_dedup.DISTANCE and brute.edit_distance(a, b) <= 0.1 * max(len(a), len(b)):
                links.append((places[a][0], places[b][0]))
    assert links
    root = brute.groups(links)
    firsts = [found[0] for found in places.values()]
    kept = {first for first in firsts if root.get(first, first) == first}
    expected = {}
    for i, text in enumerate(texts):
        expected[i] = [at for at, raw in enumerate(text.split("\n"))
                       if any(c.isalnum() for c in raw) and (i, at) not in kept]
    got = {r.doc_id: r.removed for r in line_dedup.line_marks(df).collect()}
    assert got == expected
    left = {r.doc_id: r.text for r in line_dedup.line_dedup(df).collect()}
    for i, text in enumerate(texts):
        stay = [raw for at, raw in enumerate(text.split("\n")) if at not in expected[i]]
        assert left.get(i) == ("\n".join(stay) if stay else None)


def test_simhash_of_a_long_line(docs):
    """Beyond the narrow counters the bits are still those of the majority."""
    df = docs([" ".join(["aa"] * 600 + ["bb"] * 599), " ".join(["aa"] * 3 + ["bb"] * 2)])
    folded = line_dedup._folded(line_dedup._lines(df))
    sims = {r.sim for r in line_dedup.simhashes(folded).collect()}
    assert len(sims) == 1


def test_near_variants_are_one_group(docs):
    """Lines of one family are connected although not all of their pairs are made."""
    base = [f"word{i}" for i in range(400)]
    texts = []
    for i in range(30):
        copy = list(base)
        copy[i] = "x"
        texts.append(" ".join(copy))
    removed = {r.doc_id: len(r.removed) for r in line_dedup.line_marks(docs(texts)).collect()}
    assert removed[0] == 0 and sum(removed.values()) >= 20


def test_lines_of_high_edit_similarity_are_found(docs):
    """By edit distance alone: a word of a line is another one, in lines of ordinary length."""
    rng = random.Random(4)
    vocabulary = [f"word{i}" for i in range(300)]
    texts = []
    for n in (12, 20, 28, 40) * 10:
        line = rng.choices(vocabulary, k=n)
        copy = list(line)
        copy[rng.randrange(n)] = f"word{rng.randrange(300)}"
        texts += [" ".join(line), " ".join(copy)]
    near = [
        brute.edit_distance(a, b) <= 0.1 * max(len(a), len(b)) and a != b
        for a, b in zip(texts[::2], texts[1::2])
    ]
    removed = {r.doc_id: len(r.removed) for r in line_dedup.line_marks(docs(texts)).collect()}
    found = [removed[2 * i + 1] == 1 for i in range(len(near)) if near[i]]
    assert len(found) >= 35 and sum(found) >= 0.95 * len(found)
    assert not any(removed[2 * i] for i in range(len(near)))


def test_lines_of_many_rows_of_one_id(docs):
    """Each of 2,000 rows without an id loses the line it shares, and no other one."""
    rng = random.Random(6)
    own = [" ".join(f"{rng.getrandbits(60):x}" for _ in range(8)) for _ in range(2000)]
    shared = "a line that all of these rows have in common"
    rows = [(0, shared)]
    rows += [(None, "\n".join([text] * (i % 2) + [shared, text])) for i, text in enumerate(own)]
    marks = line_dedup.line_marks(docs(rows)).collect()
    got = sorted((r.n_lines, tuple(r.removed)) for r in marks)
    # Nulls come first, so the shared line stays in one of these rows.
    assert sum(n for n, _ in got) == 1 + 2 * 1000 + 3 * 1000
    assert sum(len(r) for _, r in got) == 2000 + 1000
    left = line_dedup.line_dedup(docs(rows)).filter("doc_id IS NULL").collect()
    assert sorted(line for r in left for line in r.text.split("\n")) == sorted([*own, shared])


def test_nearly_all_variants_go(docs):
    base = [f"word{i}" for i in range(400)]
    texts = [" ".join([*base[:i], "x", *base[i + 1 :]]) for i in range(30)]
    removed = [len(r.removed) for r in line_dedup.line_marks(docs(texts)).collect()]
    assert sum(removed) >= 25


def test_lines_of_odd_rows(odd, docs):
    marks = line_dedup.line_marks(odd)
    assert marks.count() == odd.count()
    assert {(str(r.doc_id), len(r.removed)) for r in marks.collect()} == {
        ("0", 0), ("1", 0), ("None", 0), ("2", 0), ("3", 0), ("4", 1), ("5", 0)
    }
    kept = line_dedup.line_dedup(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert line_dedup.line_dedup(docs([])).count() == 0


def test_pieces_that_are_absent_bound_the_edits(spark):
    """What skips the count of edits loses no pair, whatever the edits are."""
    rng = random.Random(9)
    pairs = []
    for _ in range(300):
        line = "".join(rng.choices("abcdé𝒳 ", k=rng.randint(0, 80)))
        copy = list(line)
        for _ in range(rng.randint(0, 12)):
            at = rng.randint(0, len(copy))
            copy[at : at + rng.randint(0, 1)] = rng.choices("abcé ", k=rng.randint(0, 2))
        pairs.append((line, "".join(copy)))
    absent = line_dedup._absent("a", "b")
    found = spark.createDataFrame(pairs, "a string, b string").selectExpr("a", "b", f"{absent} AS absent")
    rows = found.collect()
    assert all(r.absent <= brute.edit_distance(r.a, r.b) for r in rows)
    assert sum(r.absent > 0 for r in rows) > 100


def test_hashes_of_pieces_bound_the_edits_and_tell_unrelated_lines(spark):
    """What a line's pieces and grams are is known before it is compared: hashes that a pair reads."""
    rng = random.Random(15)
    pairs = [edited(rng, alphabet) for alphabet in ("bcdfgé𝒳 ", "etaoin bcd", "ab ", "e") for _ in range(40)]
    words = ["".join(rng.choices("abcdefghilmnoprstuy", k=rng.randint(2, 9))) for _ in range(2000)]
    shared = " ".join(rng.choices(words, k=3))
    unrelated = [f"{shared} {' '.join(rng.choices(words, k=rng.randint(30, 150)))}" for _ in range(80)]
    rows = [(i, a, b) for i, (a, b) in enumerate([*pairs, *zip(unrelated[::2], unrelated[1::2])])]
    hashes = [line_dedup._short(line_dedup._pieces("a"), "p"), line_dedup._short(line_dedup._grams("b"), "g")]
    df = spark.createDataFrame(rows, "i int, a string, b string").select("*", *hashes)
    found = [tuple(r) for r in df.selectExpr("i", "a", "b", "size(array_except(p, g))").collect()]
    near = [(n, brute.edit_distance(a, b)) for i, a, b, n in found if i < len(pairs)]
    assert all(least <= edits for least, edits in near) and sum(least > 0 for least, _ in near) > 40
    assert all(n > 0.1 * min(len(a), len(b)) for i, a, b, n in found if i >= len(pairs))


def edited(rng, alphabet):
    """A line and what some random edits make of it."""
    line = "".join(rng.choices(alphabet, k=rng.randint(1, 400)))
    copy = list(line)
    for _ in range(rng.randint(0, 12)):
        at = rng.randint(0, len(copy))
        copy[at : at + rng.randint(0, 1)] = rng.choices(alphabet, k=rng.randint(0, 2))
    return line, "".join(copy)


def test_letters_and_words_bound_the_edits(spark):
    """Counts of letters never ask for more edits than there are, words in their order never for fewer."""
    rng = random.Random(12)
    pairs = [edited(rng, alphabet) for alphabet in ("etaoinsrhldc xé𝒳", "ab ", "e") for _ in range(40)]
    pairs += [("e" * 3000, "t" * 3000), ("an apple", "a lot of pears and plums"), ("x", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    low, high = line_dedup._letters("a")
    df = df.select("a", "b", low.alias("al"), high.alias("ah"), *line_dedup._letters("b"))
    surplus = f"{line_dedup._surplus('al', 'low')} + {line_dedup._surplus('ah', 'high')}"
    back = f"{line_dedup._surplus('low', 'al')} + {line_dedup._surplus('high', 'ah')}"
    found = df.selectExpr("a", "b", f"greatest({surplus}, {back}) AS least", f"{line_dedup._aligned('a', 'b')} AS most")
    rows = [(r.least, brute.edit_distance(r.a, r.b), r.most) for r in found.collect() if len(r.a) < 3000]
    assert all(least <= edits <= most for least, edits, most in rows)
    assert sum(least > 0 for least, _, _ in rows) > 40 and sum(edits == most > 0 for _, edits, most in rows) > 10
    assert found.filter("length(a) = 3000").first().least == 255


def test_lines_of_different_groups_are_compared_once(spark, docs, monkeypatch):
    """A few lines first, then the others: together all pairs of different groups, none twice."""
    monkeypatch.setattr(line_dedup, "SOME", 3)
    rng = random.Random(13)
    base = [f"word{i}" for i in range(60)]
    texts = []
    for i in range(24):
        copy = list(base)
        copy[rng.randrange(60)] = f"other{i}"
        texts.append(" ".join(copy))
    texts += [f"alone {rng.getrandbits(90):x} and {rng.getrandbits(90):x}" for _ in range(5)]
    near = line_dedup._near_lines(line_dedup._marked(line_dedup._lines(docs(texts))), 0.9).persist()
    places = sorted(r.place for r in near.select("place").collect())
    assert len(places) == 24
    groups = spark.createDataFrame(
        [(p, places[at // 8 * 8]) for at, p in enumerate(places[:20])],
        f"node {near.schema['place'].dataType.simpleString()}, root {near.schema['place'].dataType.simpleString()}",
    )
    of = [at // 8 if at < 20 else at for at in range(24)]
    pairs = [
        tuple(sorted((places.index(r.a), places.index(r.b))))
        for some in (True, False)
        for r in line_dedup._apart(near, groups, 0.9, some).collect()
    ]
    assert len(pairs) == len(set(pairs))
    assert all(of[a] != of[b] for a, b in pairs)
    every = {(a, b) for a in range(24) for b in range(a + 1, 24) if of[a] != of[b]}
    assert len(pairs) >= 0.9 * len(every)  # those that share a block


def test_lines_that_share_a_passage_are_no_pairs_unless_near(spark, docs):
    """Of lines with one long passage only those become pairs that reach the edit similarity, once each."""
    rng = random.Random(14)
    passage = " ".join(f"word{i}" for i in range(40))
    heads = [" ".join(f"{rng.getrandbits(28):07x}" for _ in range(10)) for _ in range(30)]
    heads += [head.replace(" ", " x", 1) for head in heads[:5]]
    texts = [f"{head} {passage}" for head in heads]
    near = line_dedup._near_lines(line_dedup._marked(line_dedup._lines(docs(texts))), 0.9)
    places = sorted(r.place for r in near.select("place").collect())
    assert len(places) == 35
    # That the passage alone links all of them is what the blocks say, not the edits.
    kind = near.schema["place"].dataType.simpleString()
    groups = spark.createDataFrame([], f"node {kind}, root {kind}")
    pairs = [
        tuple(sorted((places.index(r.a), places.index(r.b))))
        for some in (True, False)
        for r in line_dedup._apart(near, groups, 0.9, some).collect()
    ]
    assert sorted(pairs) == [
        (a, b) for a in range(35) for b in range(a + 1, 35)
        if brute.edit_distance(texts[a], texts[b]) <= 0.1 * max(len(texts[a]), len(texts[b]))
    ]
    assert len(pairs) == 5


def test_shuffles_of_lines_leave_the_disk(spark, docs):
    """What made the blocks of lines is not kept beside them until the query ends."""
    jvm = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    rng = random.Random(3)
    before = jvm.getAllFiles().size()
    texts = ["\n".join(f"{rng.getrandbits(80):x} {rng.getrandbits(80):x}" for _ in range(20)) for _ in range(50)]
    lines = line_dedup._marked(line_dedup._lines(docs(texts)))
    assert materialise_alone(lines, "lines").count() == 1000
    assert jvm.getAllFiles().size() <= before + 8
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_pairs_in_shares(spark):
    """More pairs than lines: each is looked at once, whichever share it is in."""
    lines = [f"the same words in all of these lines but for the last one {i:x}" for i in range(12)]
    lines += [f"{i} " * 20 for i in range(100, 112)]
    texts = spark.createDataFrame(list(enumerate(lines)), "place int, line string")
    every = [(a, b) for a in range(24) for b in range(a + 1, 24)]
    found = line_dedup._verified(spark.createDataFrame(every, "a int, b int"), texts, 0.9)
    got = sorted(map(tuple, found.collect()))
    assert got == [
        (a, b) for a, b in every
        if brute.edit_distance(lines[a], lines[b]) <= 0.1 * max(len(lines[a]), len(lines[b]))
    ]
    assert len(got) >= 66 and len(found.inputFiles()) >= 2


def test_counters_of_any_width_give_the_same_bits(spark):
    rng = random.Random(8)
    rows = [([rng.getrandbits(64) - (1 << 63) for _ in range(n)],) for n in (1, 2, 7, 100, 255)]
    df = spark.createDataFrame(rows, "h array<bigint>")
    for h, *bits in df.selectExpr("h", *[line_dedup._majority("h", lane) for lane in (9, 21, 63)]).collect():
        set_ = [2 * sum(x >> k & 1 for x in h) > len(h) for k in range(63)]
        assert bits == [sum(1 << k for k in range(63) if set_[k])] * 3
