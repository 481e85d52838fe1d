"""Compression classifier: zstandard dictionaries of good and of bad text.

Two dictionaries are trained, one from good and one from bad labelled texts. A text, in blocks of
BLOCK bytes, is compressed with either; the difference of the two sizes over the larger one says which
kind of text it is like. A logistic fit makes that difference, with the compression rate and the length
that say how far to trust it, a score between 0 and 1.

The fit takes at most PER_CLASS labelled documents of each class. Half of them train the dictionaries
and the other half the calibration, so that no text is calibrated on a dictionary that has seen it.

Cases: null and empty texts are scored as empty text; very long texts are scored whole; repeated rows
are scored each; without documents of both classes there is nothing to tell and every score is the
share of label 1, or 0.5 without any label; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.calibration import Logistic
from tablelift.llm.common import text_bytes, trimmed
from tablelift.llm.labelled import sample

PER_CLASS = 3000
BLOCK, PIECE, LEVEL = 4096, 1024, 3
DICTIONARY_BYTES, TRAINING_PIECES = 112_640, 6000


def _pieces(data: bytes, size: int) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)]


def _dictionary(texts: list[bytes], random: np.random.Generator) -> bytes:
    pieces = [p for t in texts for p in _pieces(t, PIECE) if len(p) >= 32]
    pieces = [pieces[i] for i in random.permutation(len(pieces))[:TRAINING_PIECES]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text to train on: its plain content serves
        return b"".join(pieces)[-DICTIONARY_BYTES:] or b" " * 8


class Model:
    def __init__(self, good: bytes, bad: bytes, prior: float):
        self.good, self.bad, self.prior, self.logistic = good, bad, prior, None
        self._compressors = None

    def __getstate__(self):
        return self.__dict__ | {"_compressors": None}

    @classmethod
    def fit(cls, texts: list[str], labels: np.ndarray) -> Model:
        prior = float(labels.mean()) if len(labels) else 0.5
        random = np.random.default_rng(7)
        data = [t.encode() for t in texts]
        learn = random.permutation(len(data)) % 2 == 0
        parts = [[d for d, y, a in zip(data, labels, learn, strict=True) if y == k and a] for k in (1, 0)]
        if not all(parts) or len(set(labels[~learn])) < 2:
            return cls(b"", b"", prior)
        model = cls(_dictionary(parts[0], random), _dictionary(parts[1], random), prior)
        x = model.features([d for d, a in zip(data, learn, strict=True) if not a])
        model.logistic = Logistic.fit(x, labels[~learn])
        return model

    def features(self, data: list[bytes]) -> np.ndarray:
        if self._compressors is None:
            self._compressors = []
            for raw in (self.good, self.bad):
                trained = zstandard.ZstdCompressionDict(raw)
                trained.precompute_compress(level=LEVEL)
                self._compressors.append(zstandard.ZstdCompressor(dict_data=trained, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False))
        good, bad = (c.compress for c in self._compressors)
        sizes = np.empty((len(data), 3))
        for i, d in enumerate(data):
            blocks = _pieces(d, BLOCK)
            sizes[i] = sum(len(good(b)) for b in blocks), sum(len(bad(b)) for b in blocks), len(d)
        g, b, n = sizes.T
        difference = (b - g) / np.maximum(np.maximum(g, b), 1)
        rate, length = np.log((g + 1) / (n + 1)), np.log1p(n)
        short = np.exp(-n / 100)
        return np.column_stack([difference, np.clip(difference, -0.1, 0.1), rate, rate**2, length, difference * length, rate * length, short, short * rate])

    def score(self, data: list[bytes]) -> np.ndarray:
        if self.logistic is None:
            return np.full(len(data), self.prior)
        return self.logistic.score(self.features(data)) if data else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, learn, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """`learn`: a condition on doc_id for the labels that may be learned from."""
    return Model.fit(*sample(docs, labels, label, learn, per_class))


_SCORED = pa.schema([("doc_id", pa.int64()), ("scored", pa.float64())])


def scores(docs: DataFrame, model) -> DataFrame:
    """doc_id and the score of each whole text. model: anything with score(list of bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(model.score(text_bytes(b["text"])), pa.float64())], schema=_SCORED)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(trimmed(run), "doc_id long, scored double").withColumnRenamed("scored", "score")


def keep_scored(docs: DataFrame, model, least: float) -> DataFrame:
    """The rows of docs, unchanged, whose text scores at least `least`. All columns are kept."""
    places = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = pa.array(model.score(text_bytes(b.column(len(places)))) >= least)
            yield pa.RecordBatch.from_arrays(b.columns[: len(places)], names=[f"c{i}" for i in range(len(places))]).filter(kept)

    numbered = docs.toDF(*[f"c{i}" for i in range(len(places))])
    whole = numbered.withColumn("whole_text", F.col(f"c{places.index('text')}").cast("string"))
    return whole.mapInArrow(trimmed(run), numbered.schema).toDF(*places)
