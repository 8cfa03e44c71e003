"""Counting quotient filters of packed word-id n-grams, lossless, in numpy.

An n-gram of up to three word ids is one whole number of 3 * bits bits. A Feistel network permutes these numbers, so
that they spread evenly and can be read back. The permuted number is held as two halves; its leading bits are the
quotient, all others the remainder. A filter is its entries in sorted order without their common leading bits: a
bit vector of occupied quotients, a bit vector of run ends, the full remainders packed bit by bit, and counters
of one byte with an escape for larger ones. Nothing is lost: entries come out as they went in, with exact counts.

Sorted filters of shards merge into a sorted filter, and a filter splits by leading bits into those of finer ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from driftline.llm.blocks import squeeze, unsqueeze

#: Word ids have at most this many bits, so that the halves of three ids stay below 64.
MOST_BITS = 31
ROUNDS = 4


def _mix(x: np.ndarray, turn: int) -> np.ndarray:
    """64-bit finaliser; need not be invertible, as the network around it is."""
    x = (x + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Packing:
    """How ids of `bits` bits become permuted numbers of two halves, and back."""

    bits: int

    def __post_init__(self) -> None:
        if not 1 <= self.bits <= MOST_BITS:
            raise ValueError(f"word ids of {self.bits} bits do not fit")

    @property
    def half(self) -> int:
        return (3 * self.bits + 1) // 2

    @property
    def mask(self) -> np.uint64:
        return np.uint64((1 << self.half) - 1)

    def pack(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Permuted halves of the n-grams; first is 0 for those of two words."""
        b, h = self.bits, self.half
        low = (third | (second << np.uint64(b))) & self.mask
        high = (second >> np.uint64(h - b)) | (first << np.uint64(2 * b - h))
        for turn in range(ROUNDS):
            high, low = low, high ^ (_mix(low, turn) & self.mask)
        return high, low

    def unpack(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        b, h = self.bits, self.half
        for turn in reversed(range(ROUNDS)):
            high, low = low ^ (_mix(high, turn) & self.mask), high
        one = np.uint64((1 << b) - 1)
        second = ((low >> np.uint64(b)) | (high << np.uint64(h - b))) & one
        return high >> np.uint64(2 * b - h), second, low & one

    def summed(self, high: np.ndarray, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entries in sorted order, equal ones as one with the sum of their counts."""
        if not len(high):
            return high, low, count
        if 2 * self.half <= 64:
            order = np.argsort((high << np.uint64(self.half)) | low, kind="stable")
        else:
            order = np.lexsort((low, high))
        high, low, count = high[order], low[order], count[order]
        new = np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))
        starts = np.flatnonzero(new)
        return high[starts], low[starts], np.add.reduceat(count, starts)


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of each value, as a matrix of 0 and 1."""
    raw = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, count=width, bitorder="little") if width else np.zeros((len(values), 0), np.uint8)


def _values(bits: np.ndarray) -> np.ndarray:
    raw = np.zeros((len(bits), 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    raw[:, : packed.shape[1]] = packed
    return raw.view("<u8").reshape(-1).astype(np.uint64)


def _head(n: int, free: int) -> int:
    """Bits of the quotient of a filter of n entries with `free` bits left in the leading half."""
    return min(free, max(1, (n - 1).bit_length()))


def encode(high: np.ndarray, low: np.ndarray, count: np.ndarray, half: int, common: int) -> bytes:
    """A filter of sorted entries whose first `common` bits are equal (and not stored)."""
    n, free = len(high), half - common
    q = _head(n, free)
    rest = free - q
    local = high & np.uint64((1 << free) - 1)
    quotient = local >> np.uint64(rest)
    occupied = np.zeros(1 << q, np.uint8)
    occupied[quotient.astype(np.int64)] = 1
    ends = np.append(quotient[1:] != quotient[:-1], True).astype(np.uint8)
    remainder = np.hstack([_bits(low, half), _bits(local, rest)])
    small = np.minimum(count, 255).astype(np.uint8)
    large = np.ascontiguousarray(count[count >= 255], "<u8")
    parts = [np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), np.packbits(remainder).tobytes()]
    counters = squeeze(small.tobytes() + large.tobytes())
    return b"".join([n.to_bytes(8, "little"), len(counters).to_bytes(8, "little"), *parts, counters])


def decode(data: bytes, half: int, common: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a filter, sorted; `prefix` are their common leading bits."""
    n, tail = (int.from_bytes(data[i : i + 8], "little") for i in (0, 8))
    free = half - common
    q = _head(n, free)
    rest, at = free - q, 16

    def read(bits: int) -> np.ndarray:
        nonlocal at
        size = (bits + 7) // 8
        out = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=bits)
        at += size
        return out

    occupied, ends = np.flatnonzero(read(1 << q)), read(n)
    remainder = read(n * (half + rest)).reshape(n, half + rest)
    run = np.concatenate([[0], np.cumsum(ends)[:-1]]).astype(np.int64)
    low, below = _values(remainder[:, :half]), _values(remainder[:, half:])
    high = (np.uint64(prefix) << np.uint64(free)) | (occupied[run].astype(np.uint64) << np.uint64(rest)) | below
    counters = unsqueeze(data[at : at + tail])
    count = np.frombuffer(counters, np.uint8, n).astype(np.uint64)
    count[count == 255] = np.frombuffer(counters, "<u8", offset=n)
    return high, low, count


def split(entries: tuple[np.ndarray, np.ndarray, np.ndarray], half: int, common: int):
    """(prefix, filter) for each occupied range of `common` leading bits of sorted entries."""
    high, low, count = entries
    prefix = (high >> np.uint64(half - common)).astype(np.int64)
    starts = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1])) if len(prefix) else np.zeros(0, np.int64)
    for a, b in zip(starts, np.append(starts[1:], len(prefix)), strict=True):
        yield int(prefix[a]), encode(high[a:b], low[a:b], count[a:b], half, common)


def merge(filters: list[bytes], packing: Packing, common: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted entries of several filters of one range, counts of equal ones added."""
    parts = [decode(f, packing.half, common, prefix) for f in filters]
    return packing.summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
