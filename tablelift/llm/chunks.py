"""Ids of texts by chunks that are encoded once: a bounded table of known chunks, looked up as arrays.

The splitting pattern of byte-level BPE has no look-behind, and its matches end before white space, between a letter
and a mark and between a mark and a letter (but for apostrophes). So a text may be cut before each run of white
space, and between ASCII letters and marks, and every chunk encoded alone.

A chunk is known by 96 bits of hashes, over at most LONGEST bytes; longer chunks are encoded each time.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tablelift.llm.shingles import groups, mix

#: Fixed value: the splitting pattern for which the cuts hold.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Chunks that a worker keeps, and bytes of a slice of texts.
KNOWN, SLICE, LONGEST = 1_000_000, 1 << 20, 64
_random = np.random.default_rng(20240306)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE32 = _random.integers(0, 1 << 31, 256, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14), *range(0x1C, 0x20)]] = True
#: Classes of ASCII characters: white space 1, letters 2, marks other than the apostrophe 3.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, *range(9, 14)]] = 1
_CLASS[[c for c in range(128) if chr(c).isalpha()]] = 2
_CLASS[[ord(c) for c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]] = 3
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


class _Powers:
    """Powers of a base and of its inverse, as many as were needed so far."""

    def __init__(self, dtype, bits: int):
        self.dtype, self.base, self.inverse = dtype, _BASE & ((1 << bits) - 1) | 1, pow(_BASE & ((1 << bits) - 1) | 1, -1, 1 << bits)
        self.n, self.up, self.down = 0, np.zeros(0, dtype), np.zeros(0, dtype)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = n
            for name, base in (("up", self.base), ("down", self.inverse)):
                out = np.full(n, base, self.dtype)
                out[:1] = 1
                setattr(self, name, np.multiply.accumulate(out, dtype=self.dtype))
        return self.up, self.down


_wide, _narrow = _Powers(np.uint64, 64), _Powers(np.uint32, 32)


def _spaces(raw: np.ndarray) -> np.ndarray:
    """Bytes that begin or end a white-space character; some that are near to one count too, which only costs a cut."""
    out = _SPACE[raw]
    lead = np.flatnonzero(_LEADS[raw])
    if len(lead):
        lead = lead[lead < len(raw) - 2]
        a, b, c = raw[lead], raw[lead + 1], raw[lead + 2]
        two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        three = ((a == 0xE1) & (((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E)))) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        three |= (a == 0xE2) & (((b == 0x80) & ((c <= 0x8F) | ((c >= 0xA8) & (c <= 0xAF)))) | ((b == 0x81) & (c == 0x9F)))
        out[lead[two | three]] = True
        out[lead[two] + 1] = True
        out[lead[three] + 2] = True
    return out


class Chunks:
    """`encode_new(data, starts, ends, plain)` returns the ids of chunks of the data, an array for each. Plain chunks
    begin with one space or none, end with none and have no line break."""

    def __init__(self, encode_new: Callable[[bytes, np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]]):
        self.encode_new = encode_new
        self.forget()

    def forget(self) -> None:
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        empty = (np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int32))
        self.old, self.new = empty, empty  # hash, check, place in the pool, number of ids; by hash

    def _store(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of ids in the pool."""
        counts = np.array([len(p) for p in parts], np.int32)
        total = int(counts.sum())
        if self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(total, len(self.pool)), np.uint32)])
        if total:
            self.pool[self.used : self.used + total] = np.concatenate(parts)
        places = self.used + np.cumsum(counts, dtype=np.int64) - counts
        self.used += total
        return places, counts

    def _find(self, table, keys, checks, place, count) -> np.ndarray:
        at = np.searchsorted(table[0], keys)
        at[at == len(table[0])] = 0
        known = (table[0][at] == keys) & (table[1][at] == checks) if len(table[0]) else np.zeros(len(keys), bool)
        place[known], count[known] = table[2][at[known]], table[3][at[known]]
        return known

    def _add(self, rows) -> None:
        def merged(a, b):
            whole = [np.concatenate(c) for c in zip(a, b, strict=True)]
            order = np.argsort(whole[0], kind="stable")
            return tuple(c[order] for c in whole)

        self.new = merged(self.new, rows)
        if len(self.new[0]) > 4096 + len(self.old[0]) // 4:
            self.old, self.new = merged(self.old, self.new), tuple(c[:0] for c in self.new)

    def _slice(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.old[0]) + len(self.new[0]) > KNOWN or self.used > 8 * KNOWN:
            self.forget()
        data = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(data, np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        text_end = np.cumsum(sizes + 1) - 1
        text_start = text_end - sizes
        space, kind = _spaces(raw), _CLASS[raw]
        # the line breaks between texts are cuts too, but begin no chunk
        cut = ((kind == 1) & ~np.concatenate([[True], space[:-1]])) | np.concatenate([[False], kind[1:] + kind[:-1] == 5]) & (kind > 1)
        cut[text_end] = False
        cut[text_start[sizes > 0]] = False
        starts = np.sort(np.concatenate([text_start, np.flatnonzero(cut)]), kind="stable")
        first = np.searchsorted(starts, text_start)
        ends = np.append(starts[1:], text_end[-1])
        ends[np.append(first[1:], len(starts)) - 1] = text_end
        length = ends - starts
        up, down = _wide.of(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=np.uint64, out=sums[1:])
        keys = mix((sums[ends] - sums[starts]) * down[starts] + length.astype(np.uint64))
        up, down = _narrow.of(len(raw) + 1)
        sums32 = np.zeros(len(raw) + 1, np.uint32)
        np.cumsum(_BYTE32[raw] * up[: len(raw)], dtype=np.uint32, out=sums32[1:])
        checks = (sums32[ends] - sums32[starts]) * down[starts]
        breaks = np.cumsum(raw == 0x0A)
        plain = (length > 0) & ~space[ends - 1] & (breaks[ends - 1] == breaks[starts]) & (~space[starts] | ((raw[starts] == 0x20) & ~space[np.minimum(starts + 1, len(raw) - 1)]))

        def alone(at):
            return self.encode_new(data, starts[at], ends[at], plain[at])

        # long chunks are not looked up
        far = np.flatnonzero(length > LONGEST)
        names, index, inverse = np.unique(keys, return_index=True, return_inverse=True)
        lone = np.concatenate([far, np.flatnonzero(checks != checks[index][inverse])])
        place, count = np.empty(len(names), np.int64), np.empty(len(names), np.int32)
        known = self._find(self.old, names, checks[index], place, count)
        missing = np.flatnonzero(~known)
        if len(missing):
            sub = [np.empty(len(missing), np.int64), np.empty(len(missing), np.int32)]
            found = self._find(self.new, names[missing], checks[index[missing]], *sub)
            place[missing], count[missing] = sub
            missing = missing[~found]
        missing = missing[length[index[missing]] <= LONGEST]
        if len(missing):
            at = index[missing]
            place[missing], count[missing] = self._store(alone(at))
            self._add((names[missing], checks[at], place[missing], count[missing]))
        place, count = place[inverse], count[inverse].astype(np.int64)
        pool = self.pool
        if len(lone):
            parts = alone(lone)
            count[lone] = [len(p) for p in parts]
            place[lone] = len(pool) + np.cumsum(count[lone]) - count[lone]
            pool = np.concatenate([pool, *parts])
        total = np.cumsum(count)
        ids = pool[np.repeat(place - (total - count), count) + np.arange(total[-1])]
        return ids, np.add.reduceat(count, first)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and their number in each text."""
        parts = [self._slice(texts[lo:hi]) for lo, hi in groups(texts, SLICE)]
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return tuple(map(np.concatenate, zip(*parts, strict=True)))
