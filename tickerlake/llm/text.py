"""Whole texts as numpy arrays: word and character hashes by segment, for Python tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes over all bits (invertible, so distinct stay distinct)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def chunks(sizes: Sequence[int], limit: int) -> Iterator[slice]:
    """Runs of neighbours whose sizes sum to about ``limit``; a larger one is alone."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > limit:
            yield slice(lo, i)
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield slice(lo, len(sizes))


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word (A-Z lower-cased) and how many words each text has."""
    return words_and_endings(texts)[:2]


def words_and_endings(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word, words of each text, and every word's last three bytes as a number."""
    joined = b"\n".join(texts) + b"\n"
    buf = _LOWER[np.frombuffer(joined, np.uint8)]
    inside = ~_SPACE[buf]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    per_text = np.diff(np.searchsorted(starts, ends), prepend=0)
    if not len(starts):
        return np.zeros(0, np.uint64), per_text, np.zeros(0, np.uint64)
    lengths = stops - starts
    powers = np.cumprod(np.full(lengths.max(), _BASE, np.uint64))
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    hashes = np.add.reduceat(_BYTE[buf[inside]] * powers[place], first)
    ending = np.zeros(len(starts), np.uint64)
    for back in (1, 2, 3):
        byte = np.where(lengths >= back, buf[np.maximum(stops - back, 0)], 0)
        ending = ending << np.uint64(8) | byte.astype(np.uint64)
    return mixed(hashes + lengths.astype(np.uint64)), per_text, ending


def as_bytes(texts: Sequence[str | None]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
