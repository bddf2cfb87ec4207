"""Language identification, packing, toxicity."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from clickstream.llm import language_id, packing, tokens, toxicity
from clickstream.llm.queries import TOKENIZER

# Language identification

EN = "the quick brown fox and the lazy dog are in the garden with this and that"
DE = "der schnelle braune Fuchs und der faule Hund sind im Garten mit diesem und jenem"


def trigram_counts(text):
    """Buckets of a text's trigrams, byte by byte."""
    letters = [chr(b) if b >= 128 or chr(b).isalpha() else " " for b in text.encode()]
    letters = [c.lower() if c < "\x80" else c for c in letters]
    framed = [" "]
    for c in [*letters, " "]:
        if c != " " or framed[-1] != " ":
            framed.append(c)
    values = [ord(c) for c in framed]
    grams = zip(values, values[1:], values[2:])
    return [((a << 16 | b << 8 | c) * 0x9E3779B1 % 2**32) >> (32 - language_id.BITS) for a, b, c in grams]


@given(st.lists(st.text("ab é!\n", max_size=12), max_size=6))
@settings(max_examples=200, deadline=None)
def test_trigrams(texts):
    buckets, at = language_id.trigrams([t.encode() for t in texts])
    expected = [trigram_counts(t) for t in texts]
    assert [buckets[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == expected


def brute_posteriors(rows, model_rows, strength=language_id.STRENGTH):
    """The formulas of the module, row by row."""
    names = sorted({lang for lang, _ in model_rows})
    size = 1 << language_id.BITS
    counts = {name: Counter() for name in names}
    for lang, text in model_rows:
        counts[lang].update(trigram_counts(text))
    total = {n: sum(counts[n].values()) for n in names}

    def softmax(logs):
        top = max(logs)
        mass = [math.exp(x - top) for x in logs]
        return [m / sum(mass) for m in mass]

    evidence, share, known = [], [], []
    for text, *_ in rows:
        grams = trigram_counts(text or "")
        weight = min(len(grams), language_id.EVIDENCE) / max(1, len(grams))
        logs = [
            weight * sum(math.log((counts[n][g] + 0.5) / (total[n] + 0.5 * size)) for g in grams)
            for n in names
        ]
        evidence.append(logs)
        share.append(softmax(logs))
        known.append(len(grams) > 0)
    k = len(names)
    all_ = [(sum(s[i] for s, ok in zip(share, known) if ok) + 1) / (sum(known) + k) for i in range(k)]
    hosts, suffixes, suffix_of = defaultdict(list), defaultdict(list), {}
    declared = defaultdict(list)
    for (text, said, suffix, host), s, ok in zip(rows, share, known):
        if ok and host is not None:
            hosts[host].append(s)
            suffixes[suffix].append(s)
        if ok and said is not None:
            declared[said].append(s)
    out = []
    for (text, said, suffix, host), logs, s, ok in zip(rows, evidence, share, known):
        posterior = []
        for i in range(k):
            wide = all_[i]
            if suffix is not None and suffix in suffixes:
                found = suffixes[suffix]
                wide = (sum(x[i] for x in found) + strength * all_[i]) / (len(found) + strength)
            prior = wide
            if host in hosts:
                found = hosts[host]
                others = max(0.0, sum(x[i] for x in found) - (s[i] if ok else 0))
                prior = (others + strength * wide) / (len(found) - ok + strength)
            value = math.log(prior) + logs[i]
            if said in declared:
                kinds = len(declared)
                whole = sum(x[i] for found in declared.values() for x in found)
                value += math.log((sum(x[i] for x in declared[said]) + 1 / kinds) / (whole + 1))
            posterior.append(value)
        best = softmax(posterior)
        out.append((names[int(np.argmax(best))], max(best)))
    return out


def test_identify_against_the_formulas(spark, docs):
    train = [("en", EN), ("en", "this is the other text"), ("de", DE), ("de", "das ist ein Text")]
    rows = [
        (EN[:30], "en", "org", "a.org"), (DE[:30], "de", "de", "b.de"), ("der the", "de", "de", "b.de"),
        ("der the", "en", "org", "a.org"), ("zz", None, None, None), ("", "de", "de", "b.de"),
        (None, None, "org", "c.org"), ("xy", "fr", "com", "d.com"), ("12 34", "en", None, "a.org"),
    ] * 3
    schema = "text string, declared string, suffix string, host string, id long"
    df = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], schema).repartition(3)
    model = language_id.train(spark.createDataFrame(train, "language string, text string"))
    got = {r.id: (r.language, r.posterior) for r in language_id.identify(df, model).collect()}
    for i, (name, posterior) in enumerate(brute_posteriors(rows, train)):
        assert got[i][1] == pytest.approx(posterior, abs=1e-4)
        if posterior > 0.51:
            assert got[i][0] == name


def test_pages(spark):
    html = '<!doctype html><HTML class=x lang="de-AT"><script>var t="</p>"</script><p>Ja &amp; <b>nein</b>'
    pages = [(1, "https://u:p@WWW.Example.co.uk:80/a?b", html), (2, "mailto:x", "<html><p>x"), (3, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.declared, r.suffix, r.host, r.text.split()) for r in language_id.of_pages(df).collect()}
    assert got[1] == ("de", "uk", "www.example.co.uk", ["Ja", "&amp;", "nein"])
    assert got[2][:3] == (None, None, None) and got[3] == (None, None, None, [])


def test_documents_of_odd_rows(odd, docs, spark):
    kept = language_id.identified_documents(odd)
    assert kept.columns == odd.columns
    # Those without letters go; any character beyond ASCII counts as one.
    assert {str(r.doc_id) for r in kept.collect()} == {"None", "2", "3", "4", "5"}
    assert language_id.identified_documents(docs([])).count() == 0
    unlabelled = odd.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "source")
    assert language_id.identified_documents(unlabelled).count() == 0


# Packing

WILD = ["", " ", "\n", "a", "  a  b ", "it's don't 's", "é è", "日本 語", "x<|endoftext|> y",
        "a\u0085 b", "a　 b", "a   b", "\x1c a\x1d b", "a\t\t b\r\n c", "12 ab34"]


@given(st.lists(st.text(st.sampled_from("ab é\n\t'1!\u0085 　ßZ"), max_size=30), max_size=5))
@settings(max_examples=200, deadline=None)
def test_ids_are_those_of_the_tokenizer(texts):
    texts = texts + WILD
    tokenizer = tokens._tokenizer(TOKENIZER)
    for text, ids in zip(texts, tokens.encode(texts, TOKENIZER)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_packing(rows, texts, capacity):
    tokenizer = tokens._tokenizer(TOKENIZER)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    total = 0
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        at = 0
        for number, r in enumerate(sorted(pieces[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (number, at)
            assert r.length == capacity or number == 0
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return len(sequences), -(-total // capacity)


def test_packing(docs, corpus):
    used, least = check_packing(
        packing.pack_documents(docs(corpus), TOKENIZER, 64, ids=False).collect(), dict(enumerate(corpus)), 64
    )
    assert used <= least + 2
    rows = packing.pack_documents(docs(corpus), TOKENIZER).collect()
    check_packing(rows, dict(enumerate(corpus)), 2048)
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_packing_of_odd_rows(odd, docs):
    rows = packing.pack_documents(odd, TOKENIZER, ids=False).collect()
    assert Counter(r.piece for r in rows)[0] == odd.count()
    used = Counter((r.sequence_id, r.offset) for r in rows)
    assert max(used.values()) == 1
    assert packing.pack_documents(docs([]), TOKENIZER).count() == 0


def test_best_two_fit_replaces_the_shortest():
    # Greedy takes 6 and 3 and leaves a gap of 1; 2 and 2 fill what 3 and the gap left.
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10) == [({6: 1, 2: 2}, 1), ({3: 1}, 1)]


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 1000), max_size=20))
@settings(max_examples=100, deadline=None)
def test_plan_places_every_document(counts):
    plan = packing.best_two_fit(counts, 50)
    placed = Counter()
    for taken, times in plan:
        assert times > 0 and sum(n * c for n, c in taken.items()) <= 50
        for length, count in taken.items():
            placed[length] += count * times
    assert placed == Counter(counts)


# Toxicity

INSULTS = ["wretched", "scoundrel", "villain", "filthy"]


def labelled(corpus, n=400):
    import random

    rng = random.Random(4)
    words = sorted({w for t in corpus for w in t.split() if w.isalpha()})
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 120))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(INSULTS))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_held_out_accuracy(spark, docs, corpus):
    rows = labelled(corpus)
    df = docs([(i, text) for i, text, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(df, labels).collect()}
    held = [(got[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r.held_out for r, _ in held) and 60 < len(held) < 140
    assert sum(r.held_out for r in got.values()) == len(held)
    right = [r.predicted == y for r, y in held]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    # Held-out labels are never read.
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, _, y in rows]
    other = toxicity.toxicity(df, spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert {r.doc_id: r.score for r in other.collect()} == {i: r.score for i, r in got.items()}


def test_scores_are_of_the_whole_not_of_the_sample(corpus):
    """A sample with half toxic documents must not make all others half toxic."""
    rows = labelled(corpus)
    rows = [(text, int(y or i % 20 == 1)) for i, text, y in rows]  # some have nothing toxic
    toxic, ordinary = [r for r in rows if r[1]], [r for r in rows if not r[1]]
    sample = sorted((r for pair in zip(toxic, ordinary) for r in pair), key=lambda r: r[0])
    model = toxicity.fit(sample, (9000, 1000))
    scores = model.scores(np.array([70, 70, 70]), np.array([0, 2, 4]))
    assert scores[0] < 0.1 and scores[1] > 0.3 and scores[2] >= scores[1]


def test_the_whole_text_counts(corpus):
    model = toxicity.fit([(text, y) for _, text, y in labelled(corpus)])
    savings = toxicity.Savings(model.toxic, model.ordinary)
    words = toxicity.words_of(corpus[1])
    assert all(s >= model.saved for s in savings(INSULTS))
    assert sum(s >= model.saved for s in savings(words)) < 0.02 * len(words)


def test_parts_of_words_in_every_script(corpus):
    """Insults with any ending, of which no word comes twice, count by their rate."""
    import random

    rng = random.Random(5)
    rows = []
    for i, text, y in labelled(corpus):
        words = [w for w in text.split() if w not in INSULTS]
        if y:
            ends = ["".join(rng.choices("aeioulmnrst", k=4)) for _ in range(5)]
            words += [("rée\u00fbk" if i % 2 else "\u0434\u0443\u0440\u0430\u043a") + end for end in ends]
        rows.append((" ".join(words), y))
    model = toxicity.fit(rows[:300])
    savings = toxicity.Savings(model.toxic, model.ordinary)
    for text, y in rows[300:]:
        saved = savings(toxicity.words_of(text))
        hits = sum(s >= model.saved for s in saved)
        assert (model.scores(np.array([len(saved)]), np.array([hits]))[0] >= 0.3) == y


def test_toxic_parts_by_a_plain_count(corpus):
    """The table of counts and its bound, against counting anew; no fold sees its own documents."""
    rows = labelled(corpus, 120)
    texts = [toxicity.words_of(t) for _, t, _ in rows]
    labels, folds = np.array([y for *_, y in rows]), np.arange(len(rows)) % toxicity.FOLDS
    counts = toxicity._Counts(texts, labels, folds)
    for chosen in ([0, 1, 2, 3], [0, 2, 3]):
        seen = {}
        size = [int(((labels == k) & np.isin(folds, chosen)).sum()) for k in (0, 1)]
        for words, y, fold in zip(texts, labels, folds):
            if fold in chosen:
                for part, n in Counter(p for w in words for p in toxicity.parts_of(w)).items():
                    for least in toxicity.TIMES:
                        if n >= least:
                            seen.setdefault((part, least), [0, 0])[y] += 1
        tested, found = sum(c[1] > 0 for c in seen.values()), set()
        for (part, _), (o, t) in seen.items():
            ratio, share = 0, (o + t) / sum(size)
            for count, n in ((o, size[0]), (t, size[1])):
                for c, e in ((count, n * share), (n - count, n * (1 - share))):
                    ratio += 2 * c * math.log(c / e) if c else 0
            if t / size[1] > o / size[0] and ratio >= 2 * math.log(tested / toxicity.ERROR):
                found.add(part)
        assert found == counts.toxic_parts(chosen) and found


def test_an_id_on_many_rows_is_one_labelled_row(spark, docs):
    """What is collected stays within the sample."""
    df = docs([(1, f"text {i}") for i in range(500)] + [(3, "other")])
    labels = spark.createDataFrame([(1, 1)] * 9 + [(3, 0)], "doc_id long, toxic int")
    rows, sizes = toxicity.training_rows(df, labels, 2)
    assert sorted(rows) == [("other", 0), ("text 0", 1)] and sizes == (1, 1)


def test_toxicity_of_odd_rows(spark, odd, docs):
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(odd, nothing).collect()
    assert len(got) == odd.count() and {r.score for r in got} == {0.0}
    one = spark.createDataFrame([(0, 1), (1, 0), (1, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    assert toxicity.toxicity(odd, one).count() == odd.count()
    assert toxicity.toxicity(docs([]), one).count() == 0


def test_a_full_table_keeps_the_segments_at_hand(monkeypatch):
    """What the texts at hand share with earlier ones is not encoded again, and ids stay right."""
    monkeypatch.setattr(tokens, "TABLE_SEGMENTS", 40)
    encoded = []
    whole = tokens._encode_segments
    monkeypatch.setattr(tokens, "_encode_segments", lambda new, path: encoded.extend(new) or whole(new, path))
    tokenizer, table = tokens._tokenizer(TOKENIZER), tokens.Table()
    common = "".join(f" common{i}" for i in range(30))
    for n in range(8):
        texts = [common + "".join(f" own{n}x{i}" for i in range(20)), "", f"é {n}" + common]
        for text, ids in zip(texts, tokens.encode(texts, TOKENIZER, table)):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert encoded.count(b" common7") == 1 and len(table.number) < 100
