"""Hashes of runs of bytes and words, many at a time, in numpy."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20  # bytes of text hashed at a time; a longer text is a block of its own
_BASE = 0x9E3779B97F4A7C15  # any odd number
_INVERSE = pow(_BASE, -1, 1 << 64)


@functools.cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)


@functools.lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers, out=powers)


def powers(base: int, size: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below `size` or more."""
    return _powers(base, 1 << max(16, int(size - 1).bit_length()))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits after which every bit depends on all."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def run_sums(values: np.ndarray) -> np.ndarray:
    """What `run_hashes` needs of a sequence of 64-bit values."""
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.multiply(values, powers(_BASE, len(values) + 1)[: len(values)], out=sums[1:])
    np.add.accumulate(sums[1:], out=sums[1:])
    return sums


def run_hashes(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run, which depends on its values and their number alone."""
    inverse = powers(_INVERSE, len(sums))
    number = mix((stops - starts).astype(np.uint64) + np.uint64(1))
    return mix((sums[stops] - sums[starts]) * inverse[starts] ^ number)


def byte_sums(data: np.ndarray) -> np.ndarray:
    return run_sums(_byte_values()[data])


def blocks(sizes: np.ndarray, limit: int = BLOCK):
    """Ranges of consecutive texts of at most `limit` bytes together, or one longer text."""
    begin, filled = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > begin and filled + size > limit:
            yield begin, at
            begin, filled = at, 0
        filled += size
    if begin < len(sizes):
        yield begin, len(sizes)


def regrouped(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about `limit` bytes of text, told by the column `size`."""
    pending: list[pa.RecordBatch] = []
    filled = 0
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        for first, last in blocks(sizes, limit):
            size = int(sizes[first:last].sum())
            if pending and filled + size > limit:
                yield from pa.Table.from_batches(pending).combine_chunks().to_batches()
                pending, filled = [], 0
            pending.append(batch.slice(first, last - first))
            filled += size
    if pending:
        yield from pa.Table.from_batches(pending).combine_chunks().to_batches()


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in small slices, what was used for one being given back before the next."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
            pa.default_memory_pool().release_unused()


def words(data: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs without white space; a run never reaches into another text."""
    black = np.zeros(len(data) + 2, bool)
    black[1:-1] = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    begins = black[1:-1] & ~black[:-2]
    ends = black[1:-1] & ~black[2:]
    inner = text_starts[(text_starts > 0) & (text_starts < len(data))]
    begins[inner] |= black[1:-1][inner]
    ends[inner - 1] |= black[1:-1][inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
