"""Words of whole texts as 64-bit hashes, in numpy.

A word is a run of bytes other than space and 9 to 13. In UTF-8 those bytes never occur inside
another character, so bytes give the same words as characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Bytes of text hashed at once, and the length from which a single text is cut between words.
SLICE = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, grown on demand."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return cls.up[:n], cls.down[:n]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base of hashes, and of its inverse."""
    return _Powers.of(n)


Edges = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def word_edges(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words begin and end."""
    edges = np.flatnonzero(np.diff(_SPACE[b], prepend=True, append=True))
    return edges[::2], edges[1::2]


def _hashed(data: bytes, bounds: np.ndarray, find: Edges) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data``, and how many of them begin before each of ``bounds``."""
    b = np.frombuffer(data, np.uint8)
    starts, ends = find(b)
    up, down = _Powers.of(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), np.searchsorted(starts, bounds)


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text cut between words."""
    at = 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def encoded(text: str | None, lower: bool = True) -> bytes:
    data = (text or "").encode("utf-8", "surrogatepass")
    return data.translate(_LOWER) if lower else data


def hashed_words(texts: list[bytes], find: Edges = word_edges) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first, hashes, ends) for runs of texts: text first + i has the words up to ends[i].

    Runs hold about a megabyte, or one longer text. ``find`` tells where words begin and end.
    """
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) < SLICE):
            size += len(texts[last]) + 1
            last += 1
        if size > 2 * SLICE:
            parts = [_hashed(p, np.zeros(0, np.int64), find)[0] for p in _pieces(texts[first])]
            words = np.concatenate(parts)
            yield first, words, np.array([len(words)])
        else:
            bounds = np.cumsum([len(t) + 1 for t in texts[first:last]])
            words, ends = _hashed(b" ".join(texts[first:last]) + b" ", bounds, find)
            yield first, words, ends
        first = last


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        # Mixed after each word, so that order counts and sums of words don't meet.
        out = mix(out + words[k : k + len(out)])
    return out
