"""Golomb-Rice coding of sorted 64-bit numbers, vectorised with numpy."""

from __future__ import annotations

import numpy as np

_HEAD = 17  # bytes: count, first number, bits of the remainder


def encode(ordered: np.ndarray) -> bytes:
    """Sorted distinct uint64 numbers as the first one and Rice-coded gaps.

    The remainder has as many bits as the mean gap, which is best for gaps of
    hashed numbers; the quotient is in unary and has about 1.5 bits a number.
    """
    n = len(ordered)
    if n == 0:
        return b""
    gaps = np.diff(ordered)
    mean = float(gaps.astype(np.float64).mean()) if n > 1 else 1.0
    bits = min(63, max(0, int(np.floor(np.log2(max(mean, 1.0))))))
    head = np.uint64(n).tobytes() + ordered[:1].astype("<u8").tobytes() + bytes([bits])
    if n == 1:
        return head
    quotient = (gaps >> np.uint64(bits)).astype(np.int64)
    unary = np.zeros(int(quotient.sum()) + n - 1, bool)
    unary[np.cumsum(quotient + 1) - 1] = True  # zeros of the quotient, then a one
    rest = ((gaps[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(bool) if bits else np.zeros((n - 1, 0), bool)
    coded = np.packbits(unary).tobytes()
    return head + np.uint64(len(coded)).tobytes() + coded + np.packbits(rest.ravel()).tobytes()


def decode(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    n = int(np.frombuffer(data, "<u8", 1)[0])
    first = np.frombuffer(data, "<u8", 1, 8)[0]
    bits = data[16]
    if n == 1:
        return np.array([first], np.uint64)
    size = int(np.frombuffer(data[_HEAD : _HEAD + 8], "<u8")[0])
    unary = np.unpackbits(np.frombuffer(data, np.uint8, size, _HEAD + 8))
    ones = np.flatnonzero(unary)[: n - 1]
    quotient = np.diff(np.concatenate([[-1], ones])) - 1
    gaps = quotient.astype(np.uint64) << np.uint64(bits)
    if bits:
        rest = np.unpackbits(np.frombuffer(data, np.uint8, offset=_HEAD + 8 + size))[: (n - 1) * bits].reshape(n - 1, bits)
        gaps += (rest.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.concatenate([[first], first + np.cumsum(gaps)]).astype(np.uint64)
