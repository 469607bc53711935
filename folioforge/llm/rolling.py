"""Rabin-Karp hashes of word sequences, for a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from folioforge.llm.words import WordRows

#: Odd multipliers of the two polynomials modulo 2**64, and the finishing multiplier.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
FINISH = np.uint64(0xBF58476D1CE4E5B9)
#: Words that are hashed at once; a longer text is taken in overlapping stretches.
STRETCH = 1 << 18
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _hashes(lower: bool):
    def make(words: list[bytes]) -> np.ndarray:
        words = [w.translate(LOWER) for w in words] if lower else words
        return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)

    return make


_WORDS = {lower: WordRows(_hashes(lower), 2, np.uint64) for lower in (False, True)}


def word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(two 64-bit hashes of each word, words in each text); with lower, A-Z count as a-z."""
    own = _WORDS[lower]
    flat, counts = own.rows(texts)
    return own.table[flat], counts


def rolled(words: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hash of each run of `length` consecutive rows, by prefix sums of a polynomial modulo 2**64."""
    n = len(words)
    if n < length:
        return np.zeros(0, np.uint64)
    base = BASES[lane]
    inverse = pow(base, -1, 1 << 64)
    down = np.full(n, inverse, np.uint64)
    down[0] = 1
    np.multiply.accumulate(down, out=down)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * down, out=sums[1:])
    up = np.full(n - length + 1, base, np.uint64)
    up[0] = pow(base, length - 1, 1 << 64)
    np.multiply.accumulate(up, out=up)
    h = (sums[length:] - sums[: n - length + 1]) * up
    h = (h ^ (h >> np.uint64(31))) * FINISH
    return h ^ (h >> np.uint64(29))


def stretches(counts: np.ndarray, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, slice]]:
    """Texts in groups of about STRETCH words: (text numbers, first word in its text, words taken, words' slice).

    A text that is longer is a group by itself, several times, each stretch repeating `overlap` words of the last.
    """
    ends = np.cumsum(counts)
    i = 0
    while i < len(counts):
        base = int(ends[i] - counts[i])
        if counts[i] > STRETCH:
            for at in range(0, int(counts[i]) - overlap, STRETCH):
                n = min(STRETCH + overlap, int(counts[i]) - at)
                yield np.array([i]), np.array([at]), np.array([n]), slice(base + at, base + at + n)
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(ends, base + STRETCH, "right")))
        yield np.arange(i, j), np.zeros(j - i, np.int64), counts[i:j], slice(base, int(ends[j - 1]))
        i = j


def inside(counts: np.ndarray, length: int) -> np.ndarray:
    """Of the runs of `length` words over texts laid end to end, the starts of those inside one text."""
    total = int(counts.sum())
    if total < length:
        return np.zeros(0, np.int64)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)
    return np.flatnonzero(left[: total - length + 1] >= length)


def least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive hashes."""
    out, reach = h, 1
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    more = width - reach
    return np.minimum(out[: len(out) - more], out[more:]) if more else out
