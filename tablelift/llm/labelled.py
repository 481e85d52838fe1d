"""A bounded sample of labelled texts for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a text from which it is not learned from.
LONGEST = 20_000


def fold(doc_id, n: int):
    """crc32 of the doc_id as text, modulo n."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def sample(docs: DataFrame, labels: DataFrame, label: str, learn, per_class: int) -> tuple[list[str], np.ndarray]:
    """At most per_class texts of each label 0 and 1, and the labels.

    `learn` is a condition on doc_id. Rows come in the order of a hash of their doc_id, so the sample
    depends neither on partitions nor on the order of rows. Rows without a text, a doc_id or a label,
    texts over LONGEST bytes, and documents with both labels, are not learned from; of rows with one doc_id one is
    learned, and equal texts are learned once. So the driver gets 2 * per_class texts of LONGEST bytes at most.
    """
    known = labels.select(F.col("doc_id").alias("known_id"), F.col(label).cast("int").alias("label")).where(F.col("known_id").isNotNull() & F.col("label").isin(0, 1))
    one = known.where(learn(F.col("known_id"))).groupBy("known_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    order = F.xxhash64(F.col("known_id"), F.lit(17))
    chosen = [one.where(F.col("label") == k).orderBy(order, "known_id").limit(per_class) for k in (0, 1)]
    # 2 * per_class rows of two numbers: safe to broadcast at any size of the corpus
    few = F.broadcast(chosen[0].unionByName(chosen[1]).select("known_id", "label"))
    texts_of = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.octet_length("text") <= LONGEST)
    found = texts_of.join(few, F.col("doc_id") == F.col("known_id")).groupBy("known_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("label").alias("label"))
    rows = found.collect()
    texts: dict[str, int] = {}
    for r in sorted(rows, key=lambda r: (r["known_id"], r["text"])):
        texts.setdefault(r["text"], r["label"])
    return list(texts), np.array(list(texts.values()), dtype=float)
