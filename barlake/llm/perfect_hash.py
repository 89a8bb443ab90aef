"""Minimal perfect hash over 128-bit key hashes, on arrays.

Level by level, each remaining key claims a place of a bit array; keys alone
in their place stay, the others go on to the next, smaller level.  A key's
slot is the rank of its bit over all levels, so n keys get the slots 0..n-1.
"""

from __future__ import annotations

import numpy as np

GAMMA = 1.5
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = h1 + (h2 | np.uint64(1)) * np.uint64(level + 1) * _M3
        z = (z ^ (z >> np.uint64(30))) * _M1
        z = (z ^ (z >> np.uint64(27))) * _M2
        z ^= z >> np.uint64(31)
    return (z % np.uint64(size)).astype(np.int64)


def build(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes and the bits of all levels.  The (h1, h2) pairs must be distinct."""
    sizes: list[int] = []
    bits: list[np.ndarray] = []
    while len(h1):
        if len(sizes) == 400:
            raise ValueError("equal key hashes")
        size = max(2, int(GAMMA * len(h1)))
        at = _place(h1, h2, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        left = ~alone[at]
        sizes.append(size)
        bits.append(alone)
        h1, h2 = h1[left], h2[left]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def slots(h1: np.ndarray, h2: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each key in constant time; -1 for a key no level holds (other absent keys get some slot)."""
    ranks = np.cumsum(bits) - 1
    out, open_, base = np.full(len(h1), -1), np.arange(len(h1)), 0
    for level, size in enumerate(sizes):
        at = base + _place(h1[open_], h2[open_], level, size)
        hit = bits[at]
        out[open_[hit]] = ranks[at[hit]]
        open_, base = open_[~hit], base + size
    return out


#: Bits between two stored ranks.
SAMPLE = 512


def pack(bits: np.ndarray) -> tuple[bytes, bytes]:
    """The bits in words of 64, and the number of set bits before each ``SAMPLE`` of them."""
    room = np.zeros(-(-max(len(bits), 1) // SAMPLE) * SAMPLE, bool)
    room[:len(bits)] = bits
    counts = room.reshape(-1, SAMPLE).sum(1)
    return np.packbits(room, bitorder="little").tobytes(), (np.cumsum(counts) - counts).astype("<i8").tobytes()


def packed_slots(h1: np.ndarray, h2: np.ndarray, sizes: list[int], words: bytes, samples: bytes) -> np.ndarray:
    """``slots`` from the packed form: a key reads a word for each level, and one stored rank with the words behind it."""
    w, before = np.frombuffer(words, "<u8"), np.frombuffer(samples, "<i8")
    out, open_, base = np.full(len(h1), -1), np.arange(len(h1)), 0
    for level, size in enumerate(sizes):
        if not len(open_):
            break
        at = base + _place(h1[open_], h2[open_], level, size)
        bit = (at & 63).astype(np.uint64)
        hit = (w[at >> 6] >> bit) & np.uint64(1) == 1
        found, bit = at[hit], bit[hit]
        rank = before[found // SAMPLE] + np.bitwise_count(w[found >> 6] & ((np.uint64(1) << bit) - np.uint64(1)))
        first, own = found // SAMPLE * (SAMPLE // 64), found >> 6
        for k in range(SAMPLE // 64 - 1):
            inside = first + k < own
            rank[inside] += np.bitwise_count(w[(first + k)[inside]])
        out[open_[hit]] = rank
        open_, base = open_[~hit], base + size
    return out
