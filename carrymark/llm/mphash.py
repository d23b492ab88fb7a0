"""Minimal perfect hashing of 64-bit keys, with stored fingerprints.

Keys that are alone in their cell of a bit array take that cell; the others go on
to the next, smaller array. A key's slot is the rank of its bit. Each slot stores a
fingerprint of its key, so that foreign keys are told apart.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2
LEVELS = 64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing function (splitmix) of each key under a seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, LEVELS) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys.

    ``sizes``: cells of each level; ``bits``: all levels' bits packed, each level
    padded to whole bytes; ``ranks``: set bits before each byte.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        padded = -(-sizes // 8) * 8
        self.starts = np.concatenate([[0], np.cumsum(padded)]).astype(np.int64)
        counts = np.bitwise_count(bits).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(counts)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct."""
        sizes, parts, left = [], [], keys.astype(np.uint64)
        for level in range(LEVELS):
            if not len(left):
                break
            size = GAMMA * len(left)
            cells = (mix(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(cells, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[cells]]
        if len(left):
            raise ValueError("keys are not distinct")
        return cls(np.array(sizes, np.int64),
                   np.concatenate(parts) if parts else np.zeros(0, np.uint8))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some foreign keys, any slot for others."""
        keys = keys.astype(np.uint64)
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            cell = self.starts[level] + (
                mix(keys[open_], level) % np.uint64(size)).astype(np.int64)
            byte, bit = cell >> 3, cell & 7
            here = self.bits[byte] >> bit.astype(np.uint8) & 1 == 1
            low = self.bits[byte[here]] & ((1 << bit[here]) - 1).astype(np.uint8)
            found[open_[here]] = self.ranks[byte[here]] + np.bitwise_count(low)
            open_ = open_[~here]
        return found
