"""Minimal perfect hashing of a bounded set of distinct 128-bit keys.

Keys meet in a bit array; those alone in their bit are placed, the others go to the next, smaller array. The slot of a
key is the number of set bits before its own, so n keys take the slots 0 to n-1. A key that was not in the set gets
some slot or -1: callers compare what the slot holds.
"""

from __future__ import annotations

import numpy as np

from remitlens.llm.common import mix

#: Bits per key still to be placed.
SPREAD = 2.0
_MAX_LEVELS = 60


def _places(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    mixed = mix(keys[:, 0] ^ mix(keys[:, 1], 2 * level + 1), 2 * level)
    return (mixed % np.uint64(bits)).astype(np.int64)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self._ranks = []
        base = 0
        for bits in levels:
            before = np.cumsum(bits, dtype=np.int64) - bits
            self._ranks.append(before + base)
            base += int(bits.sum())
        self.size = base

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: (n, 2) distinct rows of uint64; repeated keys raise ValueError."""
        levels: list[np.ndarray] = []
        while len(keys):
            if len(levels) == _MAX_LEVELS:
                raise ValueError("keys of a perfect hash must be distinct")
            bits = max(64, int(len(keys) * SPREAD))
            places = _places(keys, len(levels), bits)
            counts = np.bincount(places, minlength=bits)
            levels.append((counts == 1).astype(np.uint8))
            keys = keys[counts[places] != 1]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        open_rows = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self._ranks, strict=True)):
            if not len(open_rows):
                break
            places = _places(keys[open_rows], level, len(bits))
            found = bits[places] == 1
            out[open_rows[found]] = ranks[places[found]]
            open_rows = open_rows[~found]
        return out

    def to_bytes(self) -> bytes:
        """Number of levels, bits of each level (little-endian 64-bit integers), then the packed bits."""
        head = np.array([len(self.levels), *map(len, self.levels)], dtype="<i8").tobytes()
        return head + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        count = int(np.frombuffer(data, "<i8", 1)[0])
        lengths = np.frombuffer(data, "<i8", count, 8)
        at, levels = 8 * (count + 1), []
        for n in map(int, lengths):
            size = (n + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n))
            at += size
        return cls(levels)


def keys_of_digests(digests: list[bytes] | np.ndarray, width: int = 32) -> np.ndarray:
    """The first 16 bytes of each digest as a key."""
    joined = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, width)
    return np.ascontiguousarray(joined[:, :16]).view("<u8").reshape(-1, 2)
