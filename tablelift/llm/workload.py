"""The registered queries opN_<name> and the pipeline."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers

from pyspark.sql import functions as F

from tablelift.llm import bpe, jaccard_join, language_id, packing, quality_classifier, quality_rules, substring_dedup, token_files, toxicity, vector_search
from tablelift.llm.common import scratch_path, table
from tablelift.llm.labelled import fold

BPE_50K = "byte_bpe_50k.json"
RANKS_MULTI_50K = "byte_bpe_multi_50k.tiktoken"


def op1_best_fit_packing(spark, sf_dir):
    pieces = packing.pieces_of(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_50K))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def _classified(spark, sf_dir, operator, folds, held):
    """Fit on the labels of the other folds, then score every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = operator.fit(docs, labels, lambda doc_id: fold(doc_id, folds) != held)
    scored = quality_classifier.scores(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_quality_classifier(spark, sf_dir):
    return _classified(spark, sf_dir, quality_classifier, 4, 2)


def op3_vector_search(spark, sf_dir):
    return vector_search.top_k(table(spark, sf_dir, "embeddings"))


def op4_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_token_files(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    token_files.write_token_file(table(spark, sf_dir, "documents"), path, public_tokenizers.path(BPE_50K))
    return token_files.read_token_file(spark, path, digest=True)


def op6_jaccard_join(spark, sf_dir):
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op7_bpe_encoding(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS_MULTI_50K), public_tokenizers.PATTERN)


def op8_quality_rules(spark, sf_dir):
    return quality_rules.judged(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    return _classified(spark, sf_dir, toxicity, 3, 1)


def queries():
    return {k: f for k, f in globals().items() if k.startswith("op")} | {"pipeline": corpus_pipeline.run}


OP3_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def oracle_sql():
    return {"op3_vector_search": OP3_SQL}
