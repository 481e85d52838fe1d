"""Byte-level BPE ids of whole texts by the tokenizers library, which sees each chunk of the texts once.

Texts that hold the string of a token of its own (such as that of the end of a text) go to the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from tablelift.llm.chunks import Chunks
from tablelift.llm.common import text_bytes

#: Chunks that are encoded in one call, a line each.
LINES = 64
_encoders: dict[str, Encoder] = {}


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: strings that the library takes out of a text as tokens of their own, before it splits the rest
        self.own_tokens = sorted({t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content})
        #: a line break before one space or none is a piece of its own; its id parts the chunks of one call
        self.line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.chunks = Chunks(self._new)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, data: bytes, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray) -> list[np.ndarray]:
        """Ids of chunks of the data. Plain ones, which begin with one space or none, end with none and have no line
        break, go in lines, many a call."""
        chunks = [data[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        out: list[np.ndarray | None] = [None] * len(chunks)
        inside = np.flatnonzero(plain).tolist() if len(self.line_break) == 1 else []
        lines = [inside[i : i + LINES] for i in range(0, len(inside), LINES)]
        left = set(range(len(chunks))).difference(inside)
        joined = [b"\n".join([chunks[i] for i in g]).decode("utf-8", "replace") for g in lines]
        for g, e in zip(lines, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.line_break[0])
            if len(cuts) != len(g) - 1:
                left.update(g)
                continue
            for i, s, t in zip(g, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)], strict=True):
                out[i] = ids[s:t]
        rest = sorted(left)
        for i, ids in zip(rest, self._library([chunks[i].decode("utf-8", "replace") for i in rest]), strict=True):
            out[i] = ids
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and their number in each text."""
        whole = {i for i, t in enumerate(texts) if any(x in t for x in self.own_tokens)}
        if not whole:
            return self.chunks.encode(texts)
        ids, counts = self.chunks.encode([t for i, t in enumerate(texts) if i not in whole])
        plain, ends = iter(np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []), []
        for i, t in enumerate(texts):
            ends.append(self._library([t.decode("utf-8", "replace")])[0] if i in whole else next(plain))
        return np.concatenate(ends), np.array([len(x) for x in ends], np.int64)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def with_end(path: str, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a column of texts (null is empty), the end id after each, and the number of ids of each text."""
    ids, counts = encoder(path).encode(text_bytes(column))
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1
