"""Hashes of words and of word sequences, for whole Arrow batches at a time."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_random = np.random.default_rng(20240229)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
_STEP = _random.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits without visible structure."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_held = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    """The powers of the base up to the n-th and some more, kept for the next slice."""
    if len(_held[0]) <= n:
        out = np.full(n + 1, _BASE, np.uint64)
        out[:1] = 1
        _held[0] = np.multiply.accumulate(out)
    return _held[0]


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and the number of words in each text."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    powers = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * powers[: len(raw)], dtype=np.uint64, out=sums[1:])
    # a word's sum is brought to the same power wherever it stands: up to the n-th, and back by a constant
    back = np.uint64(pow(_INVERSE, len(raw), 1 << 64))
    hashes = mix((sums[ends] - sums[starts]) * powers[len(raw) - starts] * back + (ends - starts).astype(np.uint64))
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    cuts = np.searchsorted(starts, np.cumsum(sizes))
    return hashes, np.diff(np.concatenate([[0], cuts]))


def sequences(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of every k consecutive words, over the ends of texts too."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, salt, np.uint64)
    for j in range(k):
        out += words[j : j + n] * _STEP[j]
    return mix(out)


def groups(texts: list[bytes], most: int = 1 << 19):
    """Slices of the list with about `most` bytes each."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
