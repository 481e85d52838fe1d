"""Byte-level BPE by a rank file, with a segment tree over the byte positions of each piece.

A text is split by a pattern, and the matches ("pieces") are encoded separately. The leaves of a
piece's tree are its byte positions; a leaf holds the rank of the pair that starts there, and an inner
node the least rank below it, the leftmost among equals. The root says which pair merges next; the merge
changes the pair that starts there, the pair of its live left neighbour and the dead right leaf, and
each change is a point update of logarithmic cost. Pieces of equal tree size are merged side by side,
one merge of each at a time, as rows of an array; a long piece has its tree to itself.

Texts are cut to chunks where the usual pattern certainly ends a match, and chunks repeat: a worker keeps the ids of
those it has seen in a table of bounded size (chunks.py). With another pattern every text is one chunk. Pieces of new
chunks are kept too, up to CACHE_PIECES.

Cases: null and empty texts have no ids; very long texts and pieces are encoded whole, in time that
grows as n log n; repeated rows are encoded each; texts that hold the strings of special tokens are
ordinary texts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.chunks import PATTERN, Chunks
from tablelift.llm.common import text_bytes, trimmed

#: Pieces that a worker keeps encoded.
CACHE_PIECES = 100_000
#: Tree size up to which pieces are merged side by side.
SIDE_BY_SIDE = 64
NONE = 1 << 30


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Pairs:
    """Rank of the token that two tokens make together, as a sorted table of pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        found = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found.append((left << 32 | right, rank))
        found.sort()
        self.keys = np.array([k for k, _ in found] or [-1], np.int64)
        self.ranks = np.array([r for _, r in found] or [NONE], np.int64)
        self.known = dict(found)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)


class Bpe:
    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.vocabulary = {i: t for t, i in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = Pairs(self.ranks)
        self.pattern = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}
        self.chunks = Chunks(self._new) if pattern == PATTERN else None
        # the bytes of all tokens, for decoding
        top = max(self.vocabulary) + 1
        self.sizes = np.array([len(self.vocabulary.get(i, b"")) for i in range(top)], np.int64)
        self.letters = np.frombuffer(b"".join(self.vocabulary.get(i, b"") for i in range(top)), np.uint8)
        self.places = np.cumsum(self.sizes) - self.sizes

    def _tree(self, size: int, rows: list[bytes]) -> list[np.ndarray]:
        """Merge rows of at most `size` bytes, a power of two, side by side."""
        n, lengths = len(rows), np.array([len(r) for r in rows])
        raw = np.zeros((n, size), np.uint8)
        for i, r in enumerate(rows):
            raw[i, : len(r)] = np.frombuffer(r, np.uint8)
        token = self.single[raw]
        place = np.arange(size)
        after = np.broadcast_to(place + 1, (n, size)).copy()
        before = np.broadcast_to(place - 1, (n, size)).copy()
        # a node is rank * size + position, so that the least node is the leftmost of the least rank
        tree = np.full((n, 2 * size), NONE * size, np.int64)
        rank = np.full((n, size), NONE, np.int64)
        rank[:, :-1] = self.pairs.of(token[:, :-1], token[:, 1:])
        rank[place[None, :] + 1 >= lengths[:, None]] = NONE
        tree[:, size:] = rank * size + place
        level = size
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        live = np.ones((n, size), bool)
        rows_left = np.flatnonzero(tree[:, 1] < NONE * size)

        def update(r: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = at + size
            tree[r, node] = value * size + at
            node = node // 2
            while node[0] >= 1:
                tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
                node = node // 2

        while len(rows_left):
            r = rows_left
            best, at = tree[r, 1] // size, tree[r, 1] % size
            gone = after[r, at]
            following = after[r, gone]
            token[r, at] = best
            after[r, at] = following
            live[r, gone] = False
            has = following < lengths[r]
            before[r[has], following[has]] = at[has]
            update(r, gone, np.full(len(r), NONE))
            ahead = np.full(len(r), NONE)
            ahead[has] = self.pairs.of(best[has], token[r[has], following[has]])
            update(r, at, ahead)
            back = before[r, at]
            h = back >= 0
            if h.any():
                update(r[h], back[h], self.pairs.of(token[r[h], back[h]], best[h]))
            rows_left = r[tree[r, 1] < NONE * size]
        return [token[i, :k][live[i, :k]] for i, k in enumerate(lengths.tolist())]

    def _long(self, row: bytes) -> np.ndarray:
        """One piece with a tree of its own."""
        n = len(row)
        size = 1 << (n - 1).bit_length()
        token = self.single[np.frombuffer(row, np.uint8)].tolist()
        known, after, before, live = self.pairs.known, list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1" * n)
        tree = [NONE * size] * (2 * size)
        tree[size : size + n - 1] = [known.get(token[i] << 32 | token[i + 1], NONE) * size + i for i in range(n - 1)]
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def update(at: int, value: int) -> None:
            node = at + size
            tree[node] = value * size + at
            node //= 2
            while node:
                tree[node] = min(tree[2 * node], tree[2 * node + 1])
                node //= 2

        while tree[1] < NONE * size:
            best, at = divmod(tree[1], size)
            gone = after[at]
            following = after[gone]
            token[at], after[at], live[gone] = best, following, 0
            update(gone, NONE)
            if following < n:
                before[following] = at
                update(at, known.get(best << 32 | token[following], NONE))
            else:
                update(at, NONE)
            if before[at] >= 0:
                update(before[at], known.get(token[before[at]] << 32 | best, NONE))
        return np.array([t for t, alive in zip(token, live, strict=True) if alive], np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers. A piece that is a token is that token."""
        out: list[bytes | None] = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif not p:
                out[i] = b""
            else:
                groups.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for size, members in groups.items():
            for lo in range(0, len(members), 8192):
                part = members[lo : lo + 8192]
                rows = [pieces[i] for i in part]
                merged = self._tree(size, rows) if size <= SIDE_BY_SIDE else map(self._long, rows)
                for i, ids in zip(part, merged, strict=True):
                    out[i] = ids.astype("<u4").tobytes()
        return out

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of stretches of text that begin and end where pieces do."""
        split = [self.pattern.findall(w) for w in words]
        new = list({p for s in split for p in s} - self.pieces.keys())
        if len(self.pieces) + len(new) > CACHE_PIECES:
            self.pieces = {}
            new = list({p for s in split for p in s})
        self.pieces.update(zip(new, self.encode_pieces([p.encode() for p in new]), strict=True))
        return [b"".join(map(self.pieces.__getitem__, s)) for s in split]

    def _new(self, data: bytes, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray) -> list[np.ndarray]:
        return [np.frombuffer(x, "<u4") for x in self._ids([data[s:e].decode("utf-8", "replace") for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])]

    def encode_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and their number in each text."""
        if self.chunks:
            return self.chunks.encode(texts)
        found = self._ids([t.decode("utf-8", "replace") for t in texts])
        return np.frombuffer(b"".join(found), "<u4"), np.array([len(x) // 4 for x in found], np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, counts = self.encode_texts([(t or "").encode() for t in texts])
        data, ends = ids.astype("<u4").tobytes(), 4 * np.cumsum(counts)
        return [data[s:e] for s, e in zip((ends - 4 * counts).tolist(), ends.tolist(), strict=True)]

    def decode_texts(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all texts, and their number in each text."""
        size = self.sizes[ids]
        total = np.cumsum(size)
        data = self.letters[np.repeat(self.places[ids] - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        ends = np.cumsum(counts)
        upto = np.concatenate([[0], total])
        return data.tobytes(), upto[ends] - upto[ends - counts]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[tuple[str, str], Bpe] = {}


def loaded(path: str, pattern: str) -> Bpe:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Bpe(path, pattern)
    return _loaded[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) and decoded (the bytes that the ids stand for)."""
    return _run(docs, path, pattern, digest=False)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """encode() with n_tokens and SHA-256 digests in place of the long columns."""
    return _run(docs, path, pattern, digest=True)


def _run(docs: DataFrame, path: str, pattern: str, digest: bool) -> DataFrame:
    kinds = [("doc_id", pa.int64(), "long")]
    kinds += [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")] if digest else [("ids", pa.binary(), "binary"), ("decoded", pa.binary(), "binary")]
    schema = pa.schema([(n, t) for n, t, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                ids, counts = bpe.encode_texts(text_bytes(part["text"]))
                decoded, sizes = bpe.decode_texts(ids, counts)
                split = [[x[s:e] for s, e in zip((np.cumsum(n) - n).tolist(), np.cumsum(n).tolist(), strict=True)] for x, n in ((ids.astype("<u4").tobytes(), 4 * counts), (decoded, sizes))]
                if digest:
                    columns = [counts, *[[hashlib.sha256(x).hexdigest() for x in texts] for texts in split]]
                else:
                    columns = split
                yield pa.RecordBatch.from_arrays([part["doc_id"], *[pa.array(c, schema.field(i + 1).type) for i, c in enumerate(columns)]], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(trimmed(run), ", ".join(f"{n} {k}" for n, _, k in kinds))
