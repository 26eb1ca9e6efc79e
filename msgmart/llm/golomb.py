"""Sorted integers as Golomb-coded gaps, with numpy."""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray) -> bytes:
    """Sorted distinct unsigned integers below 2^63. The parameter is a power of two near the mean gap.

    Layout: count (8 bytes), exponent k (1 byte), length of the unary part in bits (8 bytes), the
    quotients in unary (zeros ended by a one), the remainders in k bits each.
    """
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return b""
    gaps = np.diff(values, prepend=np.uint64(0))
    gaps[1:] -= np.uint64(1)
    k = max(0, int(values[-1] // np.uint64(n)).bit_length() - 1)
    high = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(high + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
    unary[ends] = 1
    rest = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(n, 8)[:, 8 - (k + 7) // 8 :], axis=1)[:, -k % 8 :]
    head = np.array([n], dtype="<u8").tobytes() + bytes([k]) + np.array([len(unary)], dtype="<u8").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rest.reshape(-1)).tobytes()


def decode(data: bytes) -> np.ndarray:
    """The integers of `encode`."""
    if not data:
        return np.empty(0, dtype=np.uint64)
    n, k = int(np.frombuffer(data, "<u8", 1)[0]), data[8]
    bits = int(np.frombuffer(data, "<u8", 1, 9)[0])
    body = np.frombuffer(data, np.uint8, offset=17)
    split = (bits + 7) // 8
    ends = np.flatnonzero(np.unpackbits(body[:split], count=bits))
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        rest = np.unpackbits(body[split:], count=n * k).reshape(n, k)
        bytes_ = (k + 7) // 8
        wide = np.zeros((n, 8 * bytes_), dtype=np.uint8)
        wide[:, -k:] = rest
        low = np.zeros((n, 8), dtype=np.uint8)
        low[:, 8 - bytes_ :] = np.packbits(wide, axis=1)
        gaps |= low.view(">u8").reshape(n).astype(np.uint64)
    gaps[1:] += np.uint64(1)
    return np.cumsum(gaps, dtype=np.uint64)
