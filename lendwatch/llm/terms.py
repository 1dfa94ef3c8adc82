"""Hashes of the words of many texts at once, and of the beginnings of the longer words."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

_WORD = r"[^\W\d_]+"
_SLICE = 100_000  # characters hashed together, so that they stay in the cache; a longer text is hashed alone
_BASE = 0x9E3779B97F4A7C15
Terms = tuple[np.ndarray, np.ndarray]  # ascending 64-bit hashes, and how often each occurs


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Which characters are part of words, and a random number for each."""
    inside = np.zeros(0x110000, bool)
    for found in re.finditer(_WORD, "".join(map(chr, range(0x110000)))):
        inside[found.start() : found.end()] = True
    return inside, np.random.default_rng(11).integers(1, 1 << 64, size=0x110000, dtype=np.uint64)


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_upto(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, _SLICE), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def _mixed(values: np.ndarray, seed: int) -> np.ndarray:
    values = (values ^ np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x94D049BB133111EB)
    return (values ^ (values >> np.uint64(32))).view(np.int64)


def _counted(found: np.ndarray) -> Terms:
    """As ``np.unique`` with counts, which is slow on short arrays."""
    found.sort()
    first = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=first[1:])
    at = np.flatnonzero(first)
    counts = np.empty_like(at)
    counts[:-1] = at[1:]
    counts[-1:] = len(found)
    counts -= at
    return found[at], counts


def _hashed(texts: list[str], prefix: int) -> Iterator[Terms]:
    """A word is the sum of its letters' numbers times powers of the base: differences of running sums."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters, numbers = _letters()
    inside = letters[codes]
    power, inverse = _powers_upto(len(codes) + 1)
    own = numbers[codes]
    own *= power[: len(codes)]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(own, out=sums[1:])
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[::2], edges[1::2]
    words = _mixed((sums[ends] - sums[starts]) * inverse[starts], 1)
    longer = ends - starts > prefix
    begin = starts[longer]
    parts = _mixed((sums[begin + prefix] - sums[begin]) * inverse[begin], 2)
    limits = np.cumsum([len(t) + 1 for t in texts])
    word_at = np.searchsorted(starts, limits).tolist()
    part_at = np.searchsorted(begin, limits).tolist()
    a = b = 0
    for c, d in zip(word_at, part_at, strict=True):
        yield _counted(np.concatenate((words[a:c], parts[b:d])))
        a, b = c, d


def terms_of_each(texts: Iterable[str | None], prefix: int) -> Iterator[Terms]:
    """Terms of each text: its lower-cased words, and the first ``prefix`` letters of longer ones.

    Words are runs of letters. NULL and wordless texts have no terms. Whole texts are read, in slices
    of bounded length or one by one.
    """
    some, size = [], 0
    for text in texts:
        some.append((text or "").lower())
        size += len(some[-1]) + 1
        if size >= _SLICE:
            yield from _hashed(some, prefix)
            some, size = [], 0
    if some:
        yield from _hashed(some, prefix)
