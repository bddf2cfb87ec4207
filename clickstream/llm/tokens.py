"""Token ids of whole texts, by a public tokenizer."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

from clickstream.llm.hashing import blocks, byte_sums, run_hashes

# The last bytes of white space beyond ASCII follow one of these lead bytes.
_WIDE_LEADS = (0xE1, 0xE2, 0xE3)


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _id_bytes(path: str) -> np.ndarray:
    """How many bytes of text each id stands for."""
    tokenizer = _tokenizer(path)
    sizes = np.zeros(tokenizer.get_vocab_size(), np.int64)
    added = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    for token, id_ in tokenizer.get_vocab().items():
        # A byte-level vocabulary writes each byte as one character.
        sizes[id_] = len(token.encode()) if token in added else len(token)
    return sizes


def _segment_starts(data: np.ndarray) -> np.ndarray:
    """Where the text may be cut without changing the ids: white space after something else.

    No token of a byte-level tokenizer with the usual pattern runs from a character that is not
    white space into white space, and none looks back. In doubt there is no cut.
    """
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    before = np.zeros(len(data), bool)
    ascii_word = (data > 0x20) & (data < 0x7F)
    before[1:] = ascii_word[:-1]
    wide = data >= 0x80
    safe = wide.copy()
    safe[1:] &= data[:-1] != 0xC2
    safe[2:] &= ~np.isin(data[:-2], _WIDE_LEADS)
    before[1:] |= safe[:-1]
    starts = np.flatnonzero(blank & before)
    return starts


def _segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all segments, and of each the hash; a text begins a new one."""
    cut = np.zeros(len(data) + 1, bool)
    cut[_segment_starts(data)] = True
    cut[ends] = True
    cut[0] = True
    starts = np.flatnonzero(cut[:-1])
    stops = np.append(starts[1:], len(data))
    return starts, run_hashes(byte_sums(data), starts, stops)


TABLE_SEGMENTS = 400_000  # that a table keeps before it drops those not at hand


class Table:
    """The ids of the segments met so far; a full table keeps those of the texts at hand."""

    def __init__(self):
        self.number: dict[int, int] = {}  # by hash
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def numbers(self, hashes: np.ndarray, segment, path: str) -> np.ndarray:
        """The number of each different hash; `segment(i)` is the bytes of the i-th."""
        values = hashes.tolist()
        if len(self.number) > TABLE_SEGMENTS:
            self._keep([value for value in values if value in self.number])
        new = [i for i, value in enumerate(values) if value not in self.number]
        if new:
            ids, counts = _encode_segments([segment(i) for i in new], path)
            starts = len(self.ids) + np.cumsum(counts) - counts
            first = len(self.counts)
            self.number.update((values[i], first + n) for n, i in enumerate(new))
            self.starts = np.concatenate([self.starts, starts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids])
        return np.fromiter(map(self.number.__getitem__, values), np.int64, len(values))


    def _keep(self, values: list[int]) -> None:
        own = np.fromiter(map(self.number.__getitem__, values), np.int64, len(values))
        starts, self.counts = self.starts[own], self.counts[own]
        upto = np.cumsum(self.counts)
        self.starts = upto - self.counts
        at = np.repeat(starts - self.starts, self.counts)
        self.ids = self.ids[at + np.arange(len(at))]
        self.number = {value: number for number, value in enumerate(values)}


@functools.cache
def worker_table(path: str) -> Table:
    """The table of a tokenizer that the tasks of a Python worker share, one after the other."""
    return Table()


def encode(texts: list[str], path: str, table: Table | None = None) -> Iterator[np.ndarray]:
    """The ids of each text, as `tokenizers` gives them without special tokens added.

    The texts are cut where that leaves the ids unchanged; each different segment is encoded once,
    many of them in one call, and the ids are told apart by the bytes that they stand for. With a
    `table`, what earlier texts have is not encoded again.
    """
    table = Table() if table is None else table
    encoded = [text.encode() for text in texts]
    sizes = np.array([len(e) for e in encoded], np.int64)
    whole = b"".join(encoded)
    del encoded
    if not whole:
        yield from (np.zeros(0, np.uint32) for _ in texts)
        return
    data, ends = np.frombuffer(whole, np.uint8), np.concatenate([[0], np.cumsum(sizes)])
    found = []
    for first, last in blocks(sizes):
        if ends[last] > ends[first]:
            part = data[ends[first] : ends[last]]
            starts, hashes = _segments(part, ends[first : last + 1] - ends[first])
            found.append((starts + ends[first], hashes))
    starts = np.concatenate([f[0] for f in found])
    stops = np.append(starts[1:], len(data))
    hashes, firsts, which = np.unique(
        np.concatenate([f[1] for f in found]), return_index=True, return_inverse=True
    )
    del found
    numbers = table.numbers(
        hashes, lambda i: whole[starts[firsts[i]] : stops[firsts[i]]], path
    )[which]
    counts, offsets, ids = table.counts, table.starts, table.ids
    del stops, firsts, which
    cuts = np.searchsorted(starts, ends)
    for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own = numbers[first:last]
        number = counts[own]
        upto = np.cumsum(number)
        at = np.repeat(offsets[own] - (upto - number), number)
        yield ids[at + np.arange(len(at))]


def ends_whole(segment: bytes) -> bool:
    """Whether white space after the segment leaves its tokens alone; in doubt not."""
    last = segment[-1]
    if last < 0x80:
        return 0x20 < last < 0x7F
    return len(segment) > 3 and segment[-2] != 0xC2 and segment[-3] not in _WIDE_LEADS


def _encode_segments(segments: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all segments, one after the other, and how many each has.

    Segments that begin with white space and end with something else are encoded many at a time.
    """
    tokenizer, sizes = _tokenizer(path), _id_bytes(path)
    blank = b" \t\n\v\f\r"
    batches: list[list[int]] = [[]]
    for i, segment in enumerate(segments):
        if segment[0] in blank and ends_whole(segment):
            if len(batches[-1]) == 1024:
                batches.append([])
            batches[-1].append(i)
        else:
            batches[-1:-1] = [[i]]
    counts, parts, order = np.zeros(len(segments), np.int64), [], []
    for batch in batches:
        text = b"".join([segments[i] for i in batch]).decode()
        found = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(found[0].ids, np.uint32)
        if len(batch) == 1:
            counts[batch] = len(ids)
        elif batch:
            ends = np.cumsum([len(segments[i]) for i in batch])
            cuts = np.searchsorted(np.cumsum(sizes[ids]), ends) + 1
            counts[batch] = np.diff(cuts, prepend=0)
        parts.append(ids)
        order.extend(batch)
    ids = np.concatenate(parts)
    # From the order of the batches to that of the segments.
    order = np.array(order, np.int64)
    begins = np.zeros(len(segments), np.int64)
    begins[order] = np.cumsum(counts[order]) - counts[order]
    upto = np.cumsum(counts)
    at = np.repeat(begins - (upto - counts), counts) + np.arange(len(ids))
    return ids[at], counts
