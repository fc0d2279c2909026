"""Whole-batch word and shingle hashing over UTF-8 bytes.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return; A-Z count as a-z. Everything works on one flat byte
array and its document offsets, so no Python loop runs per word. The hash of a
word depends on its bytes alone: a polynomial in an odd base modulo 2^64, then a
finaliser. Equal words hash alike on every executor and in every batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 2 << 20
CHUNK_DOCUMENTS = 60_000

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_COMBINE = np.array([pow(_BASE, 3 * k + 5, 1 << 64) ^ (0xD6E8FEB86659FD93 << k) % (1 << 64) | 1 for k in range(16)], dtype=U64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: xor-shifts and odd multipliers."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def _powers_of(base: int, size: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < size:
        grown = np.full(max(size, CHUNK_BYTES + 1), base, dtype=U64)
        grown[0] = 1
        have = _powers[base] = np.multiply.accumulate(grown)
    return have


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets from 0, bytes) of runs of rows with a few MB of text; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, where, what = column.buffers()
    rows = len(column)
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(what, dtype=np.uint8) if what is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        stop = min(max(stop, row + 1), rows, row + CHUNK_DOCUMENTS)
        yield row, offsets[row : stop + 1] - offsets[row], data[offsets[row] : offsets[stop]]
        row = stop


class Words:
    """Words of a chunk in order: document, first byte, end byte and hash of each.

    ``breaks`` marks bytes that begin a word even inside a run; without ``fold`` letter case counts.
    """

    def __init__(self, offsets: np.ndarray, data: np.ndarray, fold: bool = True, breaks: np.ndarray | None = None):
        size = len(data)
        space = np.ones(size + 2, dtype=bool)
        space[1:-1] = SPACE[data]
        word = ~space
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < size)]
        starts = word[1:-1] & space[:-2]
        starts[edges] |= word[1:-1][edges]
        ends = word[1:-1] & space[2:]
        ends[edges - 1] |= word[1:-1][edges - 1]
        if breaks is not None:
            inner = np.flatnonzero(breaks & word[1:-1] & word[:-2])
            starts[inner] = True
            ends[inner - 1] = True
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.document = np.searchsorted(offsets, self.start, side="right") - 1
        terms = (LOWER[data] if fold else data).astype(U64)
        terms += U64(1)
        terms *= _powers_of(_BASE, size + 1)[:size]
        total = np.zeros(size + 1, dtype=U64)
        np.cumsum(terms, out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * _powers_of(_BASE_INVERSE, size + 1)[self.start])
        self._total = total

    def prefix_hash(self, size: int) -> np.ndarray:
        """Hash of each word's first ``size`` bytes (of the word, where it is shorter)."""
        stop = np.minimum(self.start + size, self.end)
        return mix((self._total[stop] - self._total[self.start]) * _powers_of(_BASE_INVERSE, len(self._total))[self.start])


def shingles(words: Words, documents: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every distinct run of ``size`` words, sorted by document and hash.

    A document with fewer words has one shingle, its whole sequence; one without
    words has none.
    """
    counts = np.bincount(words.document, minlength=documents)
    total = len(words.hash)
    value = np.zeros(total, dtype=U64)
    first = np.cumsum(counts) - counts
    left = (first + counts)[words.document] - np.arange(total)  # words from here to the document's end
    for k in range(min(size, total)):  # a chunk can hold fewer words than a shingle
        shifted = np.zeros(total, dtype=U64)
        shifted[: total - k] = words.hash[k:]
        value += np.where(left > k, shifted * _COMBINE[k], U64(0))
    here = np.arange(total) - first[words.document]
    keep = (left >= size) | ((here == 0) & (counts[words.document] < size))
    value += np.minimum(left, size).astype(U64) * _COMBINE[size]
    value, document = mix(value[keep]), words.document[keep]
    order = np.argsort(value)
    order = order[np.argsort(document[order].astype(np.uint16), kind="stable")]
    value, document = value[order], document[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (document[1:] != document[:-1])
    return document[fresh], value[fresh]
