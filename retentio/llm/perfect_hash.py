"""A minimal perfect hash over 128-bit keys, in numpy.

Levels of bit arrays: on each level the keys that are still open hash to a
place in twice as many bits; a key alone at its place sets the bit and is
done, the others go on. A key's slot is the number of bits set before its
own, over all levels: 0..n-1 without a gap. A key that was never filed may
get a slot as well; the caller compares a stored fingerprint.
"""

from __future__ import annotations

import numpy as np

LEVELS = 64
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)


def mix(k1: np.ndarray, k2: np.ndarray, salt: int) -> np.ndarray:
    """64 well-mixed bits of a key (two uint64) and a salt."""
    with np.errstate(over="ignore"):
        x = k1 + (k2 | np.uint64(1)) * np.uint64(2 * salt + 1) + _A * np.uint64(salt)
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


def words64(values) -> np.ndarray:
    """Signed 64-bit hashes as uint64."""
    return np.asarray(values, dtype=np.int64).view(np.uint64)


class PerfectHash:
    """Bit arrays of all levels in one run of 64-bit words."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes = sizes                        # 64-bit words of each level
        self.bits = bits
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))

    @classmethod
    def build(cls, k1: np.ndarray, k2: np.ndarray) -> "PerfectHash":
        sizes, parts = [], []
        while len(k1):
            if len(sizes) == LEVELS:
                raise ValueError("two keys share all 128 bits")
            n = -(-2 * len(k1) // 64)
            at = mix(k1, k2, len(sizes)) % np.uint64(64 * n)
            alone = np.bincount(at.astype(np.int64), minlength=64 * n) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(n)
            rest = ~alone[at.astype(np.int64)]
            k1, k2 = k1[rest], k2[rest]
        return cls(sizes, np.concatenate(parts) if parts else np.zeros(0, "<u8"))

    def slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has it."""
        out = np.full(len(k1), -1, dtype=np.int64)
        open_, base = np.arange(len(k1)), 0
        for level, n in enumerate(self.sizes):
            if not len(open_):
                break
            at = mix(k1[open_], k2[open_], level) % np.uint64(64 * n)
            word = base + (at >> np.uint64(6)).astype(np.int64)
            bit = np.uint64(1) << (at & np.uint64(63))
            held = self.bits[word]
            found = (held & bit) != 0
            below = np.bitwise_count(held[found] & (bit[found] - np.uint64(1)))
            out[open_[found]] = self.before[word[found]] + below
            open_, base = open_[~found], base + n
        return out
