"""Texts as NumPy arrays of code points and word hashes, without a Python step per character."""

from functools import lru_cache

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point: 0 no word character, 1 letter, 2 other word character (digit)."""
    kinds = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000:
            c = chr(point)
            kinds[point] = 1 if c.isalpha() else 2 if c.isalnum() else 0
    return kinds


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts after each other, and where each text starts and ends."""
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    ends = np.cumsum([0, *map(len, texts)])
    return np.frombuffer(joined, "<u4"), ends


def spread(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers."""
    x = x ^ x >> np.uint64(30)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs of letters and digits, lower case) and the text of each.

    Equal words have equal hashes on every machine.
    """
    points, ends = code_points([t.lower() for t in texts])
    if not len(points):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = letter_table()[points] > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = ends[:-1][np.diff(ends) > 0]
    first[starts] = inside[starts]
    at = np.flatnonzero(first)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    kept = np.flatnonzero(inside)
    letters = points[kept].astype(np.uint64)
    begin = np.searchsorted(kept, at)
    lengths = np.diff(np.append(begin, len(kept)))
    offset = np.arange(len(kept)) - np.repeat(begin, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), MIX, np.uint64))
    sums = np.add.reduceat(letters * powers[offset], begin)
    owner = np.searchsorted(ends, at, side="right") - 1
    return spread(sums + lengths.astype(np.uint64)), owner
