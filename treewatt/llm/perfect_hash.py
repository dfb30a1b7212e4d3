"""A minimal perfect hash over 64-bit keys, built and read with numpy.

Keys go through levels of bit arrays. On a level every key takes the bit its hash names;
keys alone on their bit keep it, the others go to the next level. A key's slot is the
number of set bits before its own, so n keys take the slots 0 to n-1. A fingerprint of
each key is kept at its slot; a key that was never put in is told apart by it, but for
one in 2^32.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"MPH1"
ROOM = 2  # bits per key on each level
HEADER = struct.Struct("<4sIQ")


def mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """Well-spread 64-bit numbers of 64-bit keys; different keys stay different."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prints_of(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


class PerfectHash:
    """Slots of a fixed set of keys."""

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray):
        self.levels = levels
        self.prints = prints
        set_bits = [np.bitwise_count(level).astype(np.int64) for level in levels]
        totals = np.cumsum([0, *(int(x.sum()) for x in set_bits)])
        self.before = [
            np.concatenate(([0], np.cumsum(x)[:-1])) + t
            for x, t in zip(set_bits, totals, strict=False)
        ]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys must be distinct 64-bit integers; none at all is allowed."""
        keys = np.asarray(keys).astype(np.uint64)
        levels, left = [], keys
        while len(left):
            words = -(-ROOM * len(left) // 64)
            places = (mix(left, len(levels)) % np.uint64(64 * words)).astype(np.int64)
            alone = np.bincount(places, minlength=64 * words)[places] == 1
            bits = np.zeros(64 * words, np.uint8)
            bits[places[alone]] = 1
            levels.append(np.packbits(bits, bitorder="little").view("<u8"))
            left = left[~alone]
        made = cls(levels, np.zeros(len(keys), "<u4"))
        if len(keys):
            slots = made._slots(keys)
            made.prints[slots] = prints_of(keys)
        return made

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for number, (level, before) in enumerate(zip(self.levels, self.before, strict=True)):
            places = mix(keys[left], number) % np.uint64(64 * len(level))
            word, bit = (places >> np.uint64(6)).astype(np.int64), places & np.uint64(63)
            here = (level[word] >> bit) & np.uint64(1) == 1
            below = level[word] & ((np.uint64(1) << bit) - np.uint64(1))
            slots = before[word] + np.bitwise_count(below)
            out[left[here]] = slots[here]
            left = left[~here]
            if not len(left):
                break
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for keys that are not in the set."""
        keys = np.asarray(keys).astype(np.uint64)
        out = self._slots(keys)
        known = out >= 0
        known[known] = self.prints[out[known]] == prints_of(keys[known])
        return np.where(known, out, -1)

    def to_bytes(self) -> bytes:
        sizes = np.array([len(level) for level in self.levels], "<u8")
        parts = [HEADER.pack(MAGIC, len(self.levels), len(self.prints)), sizes.tobytes()]
        parts += [level.tobytes() for level in self.levels]
        return b"".join([*parts, self.prints.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[PerfectHash, int]:
        """The index stored at a place, and the place after it."""
        magic, count, keys = HEADER.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError("not a perfect-hash index")
        at += HEADER.size
        sizes = np.frombuffer(data, "<u8", count, at)
        at += 8 * count
        levels = []
        for size in sizes.tolist():
            levels.append(np.frombuffer(data, "<u8", size, at))
            at += 8 * size
        return cls(levels, np.frombuffer(data, "<u4", keys, at)), at + 4 * keys
