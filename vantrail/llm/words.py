"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. Hashes depend on the word
alone, so they agree between tasks. Two different words, or two different
sequences of words, share a hash with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task; a longer single text is handled alone.
SLICE_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the result."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_PLACE = mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + 1)
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]))
        _inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE_INVERSE)]))


@dataclass
class Words:
    """``first[d]:first[d + 1]`` are the words of text ``d``; starts and ends are bytes of ``data``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def bounds(self) -> Iterator[tuple[int, int]]:
        return zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of ``size`` words from each word on, and whether all of them lie in one text."""
        n = len(self.hashes)
        end = np.repeat(self.first[1:], self.counts())
        whole = np.arange(n) + size <= end
        if n < size:
            return np.zeros(n, np.uint64), whole
        total = np.zeros(n - size + 1, np.uint64)
        for j in range(size):
            total += self.hashes[j : n - size + 1 + j] * _PLACE[j]
        out = np.zeros(n, np.uint64)
        out[: n - size + 1] = mixed(total + np.uint64(size))
        return out, whole

    def whole(self, a: int, b: int) -> np.uint64:
        """Hash of the words ``a:b`` as one sequence."""
        with np.errstate(over="ignore"):
            total = np.uint64(b - a) * np.uint64(0xA0761D6478BD642F)
            for j, h in enumerate(self.hashes[a:b]):
                total = total + h * _PLACE[j % 64] + np.uint64(j)
        return mixed(np.array([total], np.uint64))[0]


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """All words of ``texts`` (null: none). ``lower`` turns A-Z into a-z first."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[low:high] if buffer is not None and high > low else np.zeros(0, np.uint8)
    offsets = offsets - low
    if lower:
        data = _LOWER[data]
    size = len(data)
    inside = ~_SPACE[data]
    border = np.zeros(size + 1, bool)
    border[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if size else np.zeros(0, bool)
    after = np.concatenate([inside[1:], [False]]) if size else np.zeros(0, bool)
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    _grow(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers[:size], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _inverses[starts]
    hashes = mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts have about ``limit`` bytes together."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(lengths) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)
