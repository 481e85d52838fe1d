"""Quality rules: counts of a text and its divergence from language references. DataFrame functions only.

Base rules: too few words, or too many words in five-word windows that the text repeats. The method's
rule: histograms of character classes and of common words are compared, by Jensen-Shannon distance, with
those of each language (sums over the documents of that language which pass the base rules); a text
that is far from every language is rejected, unless it is too short to have a histogram. How far words may
be is measured for each language by the distance of a text without any common word.

Cases: null and empty texts have no words and fail; very long texts are counted whole, window hashes
sorted in n log n; repeated rows are judged each; rows without a language, and languages of less than
LEAST_DOCS documents, are no reference and are judged by those there are, so that no text is a reference alone;
if no row has a language, all are one; without references only the base rules hold; a language without any of
the common words is tested by characters only; judged() drops other columns and keep()
keeps them, whatever their names.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import numbered, written

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Classes of characters, each with the character that stands for it in a count: upper case, digits, symbols, marks.
CLASSES = [("A", LOWER.upper()), ("0", "0123456789"), ("#", SYMBOLS), (".", "!\"'()+,-./:;=?@[\\]^_`{}~")]
#: Words from which a histogram says something, and the distance of character classes that rejects.
MIN_WORDS, MAX_CHARACTERS = 40, 0.30
#: The distance of common words that rejects, as a share of the distance that a text without any common
#: word has from the language; languages where that is under LEAST_SIGNAL have no common words of the lists.
MAX_WORDS_SHARE, LEAST_SIGNAL = 0.75, 0.1
#: Documents that pass the base rules, from which a language is a reference.
LEAST_DOCS = 10
#: Frequent words of some languages.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "as"],
    "fr": ["le", "la", "les", "et", "un", "une", "des", "que", "qui", "dans", "pour", "sur"],
    "de": ["der", "die", "das", "und", "den", "zu", "von", "mit", "ist", "nicht", "ein", "auf"],
    "es": ["el", "los", "las", "y", "del", "se", "por", "con", "una", "para", "su", "al"],
}
#: Bins of both histograms: upper case, digits, symbols, marks and letters; common words of each list and others.
HISTOGRAMS = {"characters": 5, "vocabulary": len(COMMON) + 1}


def _count_of(words: str, known: list[str]):
    return F.size(F.filter(words, lambda w: w.isin(known)))


def _measured(rows: DataFrame, text: str, lang: str | None, kept: list[str]) -> DataFrame:
    """The columns `kept` of rows with the language, the base counts and both histograms (arrays of counts)."""
    held = [F.col(c) for c in kept]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    language = F.col(lang).cast("string") if lang else F.lit(None).cast("string")
    # one pass over the text leaves a character for each letter of the counted classes; those of lower case and space go
    classes = "".join(mark * len(letters) for mark, letters in CLASSES)
    few = F.translate(whole, "".join(letters for _, letters in CLASSES) + LOWER + SPACES, classes)
    rows = rows.select(*held, language.alias("rule_lang"), few.alias("few_letters"), F.split(whole, f"[{SPACES}]+").alias("all_words"), F.split(whole, "\n").alias("all_lines"))
    lines = F.filter("all_lines", lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = rows.select(*held, "rule_lang", "few_letters", F.filter("all_words", lambda w: w != "").alias("words"), lines.alias("lines"))
    rows = rows.withColumn("known", F.filter("words", lambda w: w.isin(sorted(set().union(*COMMON.values())))))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    windows = F.when(F.size("hashes") >= 5, F.transform(F.slice("hashes", 1, F.greatest(F.size("hashes") - 4, F.lit(0))), lambda h, i: F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2), F.get("hashes", i + 3), F.get("hashes", i + 4)))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("windows", windows)
    same = F.size("windows") == F.size(F.array_distinct("windows"))
    placed = F.when(same, F.lit(None)).otherwise(F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("placed", placed)
    again = F.filter("placed", lambda x, j: (x["h"] == F.get("placed", j - 1)["h"]) | (x["h"] == F.get("placed", j + 1)["h"]))
    rows = rows.withColumn("starts", F.sort_array(F.transform(again, lambda x: x["i"])))
    # a start covers five words, or as many as there are to the next start
    covered = F.aggregate(F.transform("starts", lambda s, j: F.least(F.lit(5), F.coalesce(F.get("starts", j + 1) - s, F.lit(5)))), F.lit(0).cast("long"), lambda a, x: a + x)
    n_chars = F.length(F.array_join("words", ""))
    few = [(F.length("few_letters") - F.length(F.replace("few_letters", F.lit(mark), F.lit("")))).cast("double") for mark, _ in CLASSES]
    common = [_count_of("known", known).cast("double") for known in COMMON.values()]
    rows = rows.select(*held, "rule_lang", F.size("words").cast("long").alias("n_words"), n_chars.cast("long").alias("word_chars"), few[2].cast("long").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), F.array(*few).alias("few"), F.array(*common).alias("common"))
    add = lambda a, x: a + x
    rows = rows.withColumn("characters", F.concat("few", F.array(F.col("word_chars") - F.aggregate("few", F.lit(0.0), add))))
    rows = rows.withColumn("vocabulary", F.concat("common", F.array(F.col("n_words") - F.aggregate("common", F.lit(0.0), add))))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.drop("few", "common").withColumn("base_failed", failed)


def _shares(counts):
    """A histogram of counts as shares; an empty one has none."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.when(total > 0, F.transform(counts, lambda x: x / total))


def _distance(p, q):
    """Square root of the Jensen-Shannon divergence of two arrays of shares, in bits."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
    parts = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def _no_common(shares: list[float]) -> float:
    """Distance of a text without common words from a reference, whose last share is that of other words."""
    other = shares[-1]
    rest = sum(shares[:-1])  # the terms of words that the text does not have: q * log2(q / (q / 2)) = q
    return math.sqrt(max(0.0, (math.log2(2 / (1 + other)) + rest + (other * math.log2(2 * other / (1 + other)) if other > 0 else 0.0)) / 2))


REFERENCES = "array<struct<lang: string, characters: array<double>, words: array<double>, most: double>>"


def _references(rows: DataFrame):
    """A literal with the shares of each language of LEAST_DOCS documents, and the distance without common words.

    The driver gets a row of a dozen numbers for each language, and no more rows than there are languages."""
    counts = [F.sum(F.col(c)[i]).alias(f"{c}{i}") for c, n in HISTOGRAMS.items() for i in range(n)]
    sums = rows.where(~F.col("base_failed")).groupBy("rule_lang").agg(F.count("*").alias("n"), *counts).where(F.col("n") >= LEAST_DOCS)
    found = []
    for r in sums.orderBy("rule_lang").collect():
        parts = [[r[f"{c}{i}"] for i in range(n)] for c, n in HISTOGRAMS.items()]
        if all(sum(p) > 0 for p in parts):
            characters, words = ([x / sum(p) for x in p] for p in parts)
            found.append({"lang": r["rule_lang"], "characters": characters, "words": words, "most": _no_common(words)})
    # constant folding makes one literal of it, whatever the number of languages
    return F.from_json(F.lit(json.dumps([x for x in found if x["lang"] is not None] or found)), REFERENCES)


def _verdict(rows: DataFrame) -> DataFrame:
    """rows (written) with kept, from references that are made from all of them."""
    references = _references(rows)
    shared = rows.withColumn("characters", _shares(F.col("characters"))).withColumn("vocabulary", _shares(F.col("vocabulary")))
    characters = F.array_min(F.transform(references, lambda r: _distance(F.col("characters"), r["characters"])))
    words = F.array_min(F.transform(F.filter(references, lambda r: r["most"] >= LEAST_SIGNAL), lambda r: _distance(F.col("vocabulary"), r["words"]) / r["most"]))
    silent = F.exists(references, lambda r: r["lang"].eqNullSafe(F.col("rule_lang")) & (r["most"] < LEAST_SIGNAL))
    far = F.coalesce(characters > MAX_CHARACTERS, F.lit(False)) | F.coalesce(~silent & (words > MAX_WORDS_SHARE), F.lit(False))
    return shared.withColumn("kept", ~F.col("base_failed") & ((F.col("n_words") < MIN_WORDS) | ~far))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept, a row for each row of docs."""
    rows, at = numbered(docs)
    measured = written(_measured(rows, at["text"], at.get("lang"), [at["doc_id"]]), "measures")
    return _verdict(measured).select(F.col(at["doc_id"]).alias("doc_id"), *COUNTS, "kept")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with all their columns, unchanged. Rows carry their verdict: nothing is joined."""
    rows, at = numbered(docs)
    measured = written(_measured(rows, at["text"], at.get("lang"), rows.columns), "measures")
    return _verdict(measured).where("kept").select(*rows.columns).toDF(*docs.columns)
