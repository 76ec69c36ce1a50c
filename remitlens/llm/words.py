"""Hashes of the words of UTF-8 texts, computed for many texts at a time."""

from __future__ import annotations

import numpy as np

from remitlens.llm.common import mix, powers, random_table

#: The bytes between words (space, tab, line feed, vertical tab, form feed, carriage return).
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BYTE = random_table(256, 11)
_POWER = powers(0x9E3779B97F4A7C15 | 1, 1 << 12)
#: A text is hashed in pieces of about this many bytes, cut at white space.
PIECE_BYTES = 1 << 20


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of ``data``."""
    codes = np.frombuffer(data, np.uint8)
    space = _IS_SPACE[codes]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    letters = codes[~space]
    offsets = np.arange(len(letters), dtype=np.int64) - np.repeat(firsts, lengths)
    with np.errstate(over="ignore"):
        # Beyond the table of powers the position counts through a mixer.
        weight = _POWER[offsets & 4095]
        if lengths.max() > 4096:
            weight = np.where(offsets < 4096, weight, mix(offsets.astype(np.uint64), 13) | np.uint64(1))
        sums = np.add.reduceat(_BYTE[letters] * weight, firsts)
        return starts, mix(sums + lengths.astype(np.uint64), 12)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and the number of words of each text. A-Z count as a-z."""
    joined = b"\n".join(texts).lower()
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes, starts, at = [], [], 0
    while at < len(joined):
        stop = min(at + PIECE_BYTES, len(joined))
        while stop < len(joined) and joined[stop] not in SPACES:
            stop += 1
        where, values = _hash_piece(joined[at:stop])
        starts.append(where + at)
        hashes.append(values)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    owner = np.searchsorted(ends, np.concatenate(starts), side="right")
    return np.concatenate(hashes), np.bincount(owner, minlength=len(texts))


def shingle_hashes(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles, text after text (repeats included), and their number by text.

    A text with 1 to k-1 words has its whole sequence as one shingle; a text without words has none.
    """
    words, counts = word_hashes(texts)
    firsts = np.cumsum(counts) - counts
    numbers = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(texts)), numbers)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(numbers) - numbers, numbers) + firsts[owner]
    width = np.minimum(counts, k)[owner]
    total = width.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            inside = j < width
            word = words[np.minimum(starts + j, max(len(words) - 1, 0))] if len(words) else total
            total = np.where(inside, mix(total, 20 + j) + word, total)
    return mix(total, 19), numbers
