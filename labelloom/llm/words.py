"""Words and their hashes, for many texts at once.

Texts are handled as the UTF-8 bytes of a chunk of documents. The hash of a word is the sum of a
random number for each letter at its place, so no two words collide whatever those numbers are. A hash
is 64 bits wide: among a billion distinct words or shingles two differ but collide with a probability
of about 3 %.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; a longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)

#: Kinds of bytes. A word is a longest run of bytes of one kind that is not 0.
BY_SPACE = np.ones(256, dtype=np.uint8)  # all but white space
BY_SPACE[[0x20, *range(0x09, 0x0E)]] = 0
ALPHANUMERIC = np.zeros(256, dtype=np.uint8)  # ASCII letters and digits, and all beyond ASCII
ALPHANUMERIC[[*b"0123456789", *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
WITH_SIGNS = np.where(ALPHANUMERIC == 1, 1, 2 * BY_SPACE).astype(np.uint8)  # and runs of the rest
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number stirred so that every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _random(at: np.ndarray) -> np.ndarray:
    """The number of a letter at a place; ``at`` is ``256 * place + letter``."""
    return mixed((at.astype(np.uint64) + np.uint64(1)) * np.uint64(_FACTOR))


#: Those of the first 32 places.
_NEAR = _random(np.arange(32 << 8))


class Hasher:
    """Hashes of words; keeps the sums of those found last."""

    def __init__(self, kinds: np.ndarray = BY_SPACE) -> None:
        self._kinds = kinds

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """``(starts, ends, hashes, first)`` of the words (``[^\\x20\\x09-\\x0D]+`` if nothing else was
        asked for; A-Z as a-z): document ``d`` has those from ``first[d]`` up to ``first[d + 1]``."""
        n = len(data)
        if n == 0:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none.astype(np.uint64), np.zeros(len(offsets), dtype=np.int64)
        kind = self._kinds[data]
        edges = offsets[offsets < n]
        changes = kind[1:] != kind[:-1]
        opens = np.empty(n, dtype=bool)  # the byte before is of another kind, or of another text
        opens[0], opens[1:] = True, changes
        opens[edges] = True
        closes = np.empty(n, dtype=bool)
        closes[-1], closes[:-1] = True, changes
        closes[edges[edges > 0] - 1] = True
        word = kind != 0
        starts = np.flatnonzero(word & opens)
        ends = np.flatnonzero(word & closes) + 1
        sizes = ends - starts
        self._first = np.cumsum(sizes) - sizes  # of each word, among the letters of all words
        letters = _LOWER[data[word]]
        at = (np.arange(len(letters)) - np.repeat(self._first, sizes)) << 8 | letters
        far = np.flatnonzero(at >= len(_NEAR))
        numbers = _NEAR.take(at, mode="clip")
        numbers[far] = _random(at[far])
        self._sums = np.zeros(len(letters) + 1, dtype=np.uint64)
        np.cumsum(numbers, out=self._sums[1:])
        hashes = mixed(self._sums[self._first + sizes] - self._sums[self._first])
        return starts, ends, hashes, np.searchsorted(starts, offsets)

    def heads(self, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
        """Hashes, unlike those of words, of the first ``size`` bytes of the words found last."""
        if not len(starts):
            return np.zeros(0, dtype=np.uint64)
        cut = self._first + np.minimum(ends - starts, size)
        return mixed(self._sums[cut] - self._sums[self._first] + np.uint64(1))


def sequences(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each word on, as far as there are so many."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        total = total * np.uint64(_FACTOR) + hashes[j : j + n]
    return mixed(total)


def shingle_sets(hasher: Hasher, data, offsets, size: int = 5) -> list[np.ndarray]:
    """Of each document the sorted distinct hashes of its ``size``-word shingles; with fewer words
    the one of all its words; without words none."""
    _, _, hashes, first = hasher.words(data, offsets)
    every = sequences(hashes, size)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(every[a : b - size + 1]))
        else:
            out.append(sequences(hashes[a:b], b - a) if b > a else every[:0])
    return out


def chunks(batch: pa.RecordBatch, most: int = CHUNK_BYTES) -> Iterator[tuple]:
    """``(first row, last row + 1, bytes, offsets)`` of pieces of the batch's column ``text``."""
    texts = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
    n = len(texts)
    _, where, data = texts.buffers()
    if n == 0:
        return
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        b = min(b, n)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
