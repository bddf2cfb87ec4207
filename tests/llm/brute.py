"""The same results by the plainest means, for small tables."""

from __future__ import annotations

import hashlib
import re
import string
from collections import defaultdict

LAST = float("inf")  # a null id comes after all others


def id_order(doc_id):
    return LAST if doc_id is None else doc_id


def contamination(docs, benchmark, window=13):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    windows = defaultdict(set)
    for item, text in benchmark:
        found = words.findall((text or "").translate(lower))
        size = min(window, len(found))
        for at in range(len(found) - size + 1 if size else 0):
            windows[tuple(found[at : at + size])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    for doc_id, text in docs:
        found = words.findall((text or "").translate(lower))
        hit, items = set(), set()
        for at in range(len(found)):
            for size in sizes:
                key = tuple(found[at : at + size])
                if len(key) == size and key in windows:
                    hit.update(range(at, at + size))
                    items |= windows[key]
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        bad = len(hit) > 0 and 20 * len(hit) >= len(found)
        yield doc_id, len(found), len(hit), len(items), digest, bad


def repeats(docs, window, symbols, join):
    """(id, symbols, removed, runs, digest of what is kept) of each document."""
    parts = [(doc_id, symbols(text or "")) for doc_id, text in docs]
    first = {}
    for doc_id, found in parts:
        for at in range(len(found) - window + 1):
            key = tuple(found[at : at + window])
            first[key] = min(first.get(key, LAST), id_order(doc_id))
    for doc_id, found in parts:
        gone = [False] * len(found)
        for at in range(len(found) - window + 1):
            if first[tuple(found[at : at + window])] < id_order(doc_id):
                gone[at : at + window] = [True] * window
        runs = sum(g and not before for g, before in zip(gone, [False, *gone]))
        kept = join([x for x, g in zip(found, gone) if not g])
        yield doc_id, len(found), sum(gone), runs, hashlib.sha256(kept).hexdigest()


def repeated_words(docs, window=13):
    return repeats(docs, window, lambda t: t.encode().split(), b" ".join)


def repeated_bytes(docs, window=50):
    return repeats(docs, window, lambda t: list(t.encode()), bytes)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def groups(links):
    """The smallest member of the group of each linked one."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {x: root(x) for x in parent}


def near_documents(docs, shingle=5, threshold=0.8):
    """(class, links) of each position in `docs`."""
    sets = []
    for _, text in docs:
        words = (text or "").encode().split()
        count = max(1, len(words) - shingle + 1) if words else 0
        sets.append({tuple(words[i : i + shingle]) for i in range(count)})
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i].add(j)
    root = groups((a, b) for a, others in links.items() for b in others)
    return [(root.get(i, i), len(links[i])) for i in range(len(sets))]
