"""Counting quotient filters over word-id n-grams, without loss.

The ids of an n-gram are packed into one number of `n * bits` bits (up to 128) and permuted invertibly. The top
bits of the permuted number name a shard and, inside it, a quotient; all bits below are the remainder, stored
whole. A filter holds an occupied bit for each quotient, a run-end bit, a remainder and a counter for each entry, in sorted
order, so filters of a shard merge as sorted lists and every entry can be turned back to its n-gram.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

ROUNDS = 4
#: Most bits of an id, so that five of them fit into two words of 64 bits.
MOST_BITS = 25
_ESCAPE = 255

_U = np.uint64


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


def _spread(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + _U(0x9E3779B97F4A7C15 * (key + 1) % 2 ** 64)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def half_bits(n: int, bits: int) -> int:
    """Bits of either half of the packed number."""
    return (n * bits + 1) // 2


def pack(ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) halves of rows of ids (rows, n): the last id has the lowest bits."""
    n = ids.shape[1]
    half = half_bits(n, bits)
    left, right = np.zeros(len(ids), _U), np.zeros(len(ids), _U)
    for i in range(n):
        at, x = (n - 1 - i) * bits, ids[:, i].astype(_U)
        if at >= half:
            left |= x << _U(at - half)
        else:
            right |= (x << _U(at)) & _mask(half)
            if at + bits > half:
                left |= x >> _U(half - at)
    return left, right


def unpack(left: np.ndarray, right: np.ndarray, n: int, bits: int) -> np.ndarray:
    half = half_bits(n, bits)
    out = np.zeros((len(left), n), np.int64)
    for i in range(n):
        at = (n - 1 - i) * bits
        if at >= half:
            x = left >> _U(at - half)
        else:
            x = right >> _U(at)
            if at + bits > half:
                x |= left << _U(half - at)
        out[:, i] = (x & _mask(bits)).astype(np.int64)
    return out


def permute(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """A Feistel network: invertible on all pairs of `half` bits."""
    for r in range(ROUNDS):
        left, right = right, left ^ (_spread(right, r) & _mask(half))
    return left, right


def restore(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    for r in reversed(range(ROUNDS)):
        left, right = right ^ (_spread(left, r) & _mask(half)), left
    return left, right


def joined(left: np.ndarray, right: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """(high, low) words of 64 bits of the number left, right."""
    if half == 64:
        return left, right
    high = left >> _U(64 - half) if half > 32 else np.zeros_like(left)
    return high, left << _U(half) | right


def parted(high: np.ndarray, low: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    if half == 64:
        return high, low
    left = low >> _U(half)
    return (left | high << _U(64 - half) if half > 32 else left), low & _mask(half)


def shifted(high: np.ndarray, low: np.ndarray, by: int) -> np.ndarray:
    """The low word of the number without its last `by` bits."""
    if by >= 64:
        return high >> _U(by - 64) if by < 128 else np.zeros_like(high)
    return low if by == 0 else low >> _U(by) | high << _U(64 - by)


def lower(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The last `bits` bits of the number."""
    if bits >= 64:
        return high & _mask(bits - 64), low
    return np.zeros_like(high), low & _mask(bits)


def counted(high: np.ndarray, low: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct numbers, the sum of `n` (or of ones) of each, and the place of every input among them."""
    order = np.lexsort((low, high)) if len(high) and high.any() else np.argsort(low, kind="stable")
    h, v = high[order], low[order]
    new = np.ones(len(v), bool)
    new[1:] = (h[1:] != h[:-1]) | (v[1:] != v[:-1])
    first = np.flatnonzero(new)
    place = np.empty(len(v), np.int64)
    place[order] = np.cumsum(new) - 1
    if n is None:
        total = np.diff(np.append(first, len(v)))
    else:
        total = np.add.reduceat(n[order], first) if len(v) else np.zeros(0, np.int64)
    return h[first], v[first], total.astype(np.int64), place


@dataclass
class Filter:
    """Sorted distinct numbers of `bits` bits (those of one shard, without the shard's bits) with their counts."""

    high: np.ndarray
    low: np.ndarray
    count: np.ndarray
    bits: int

    def pack(self) -> bytes:
        n = len(self.low)
        q = min(max(1, n - 1).bit_length(), self.bits, 40)
        rest = self.bits - q
        quotient = shifted(self.high, self.low, rest)
        high, low = lower(self.high, self.low, rest)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient.astype(np.int64)] = True
        ends = np.append(quotient[1:] != quotient[:-1], True) if n else np.zeros(0, bool)
        size = (rest + 7) // 8
        words = np.stack([low, high], 1).astype("<u8").view(np.uint8).reshape(n, 16)[:, :size]
        large = self.count >= _ESCAPE
        small = np.where(large, _ESCAPE, self.count).astype(np.uint8)
        return b"".join([struct.pack("<qiii", n, q, self.bits, int(large.sum())), np.packbits(occupied).tobytes(),
                         np.packbits(ends).tobytes(), np.ascontiguousarray(words).tobytes(), small.tobytes(),
                         self.count[large].astype("<i8").tobytes()])

    @staticmethod
    def unpack(data: bytes) -> Filter:
        n, q, bits, n_large = struct.unpack_from("<qiii", data)
        at = struct.calcsize("<qiii")
        rest = bits - q
        size = (rest + 7) // 8

        def take(length: int) -> np.ndarray:
            nonlocal at
            at += length
            return np.frombuffer(data, np.uint8, length, at - length)

        occupied = np.flatnonzero(np.unpackbits(take(((1 << q) + 7) // 8), count=1 << q))
        ends = np.unpackbits(take((n + 7) // 8), count=n)
        words = np.zeros((n, 16), np.uint8)
        words[:, :size] = take(n * size).reshape(n, size)
        words = words.view("<u8")
        count = take(n).astype(np.int64)
        count[count == _ESCAPE] = take(8 * n_large).view("<i8")
        run = np.cumsum(ends) - ends
        quotient = occupied[run].astype(np.uint64) if n else np.zeros(0, np.uint64)
        low, high = words[:, 0].astype(_U), words[:, 1].astype(_U)
        if rest >= 64:
            high = high | quotient << _U(rest - 64)
        else:
            low = low | quotient << _U(rest)
            if rest + q > 64:
                high = high | quotient >> _U(64 - rest)
        return Filter(high, low, count, bits)


def merged(filters: list[Filter]) -> tuple[Filter, list[np.ndarray]]:
    """One filter of the sums, and for each filter the places of its entries in it."""
    high, low, count = (np.concatenate([getattr(f, n) for f in filters]) for n in ("high", "low", "count"))
    h, v, total, place = counted(high, low, count)
    return Filter(h, v, total, filters[0].bits), np.split(place, np.cumsum([len(f.low) for f in filters])[:-1])
