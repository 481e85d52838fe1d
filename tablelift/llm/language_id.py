"""Language by fused evidence: text, declared markup language, address and host.

The evidence adds up in log space: log likelihoods of a page's words, the log probability that a declared
language (of the markup, or of the address's path) is the true one, and a prior of the host. Text models are
counts of words over all documents, made by grouped aggregation; letters are not counted.

What declarations are worth is counted too: over the pages of a host that have words and declare a language,
how much of the text's posterior goes to it. That share is smoothed towards the host's domain's, which is smoothed
towards its suffix's, towards that of all pages and at last a constant, by SMOOTHING pages' worth at every level. A
host's prior is the mean text posterior of its pages with words, smoothed in the same way; declarations have no
part in it, so that a template with a wrong language does not vouch for itself.

Cases: a null or empty html has no text evidence; a null or odd url has the host ''; undeclared or
unknown languages say nothing; very long pages are read whole; repeated rows are judged each; without
labelled documents nothing is known and the language is null; other columns are dropped.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import drop_written, written

#: Pages' worth of the level above, and the chance that a declaration is true where nothing is counted.
SMOOTHING, DECLARED_TRUE = 20.0, 0.8
#: Declarations are never taken for surer or less sure than this.
LEAST_TRUE, MOST_TRUE = 0.05, 0.97
#: Most words whose weights are broadcast (some megabytes); those of all others are joined by shuffle.
HOT_WORDS = 40_000


def _words(text):
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def _entities(text):
    """Character references as the characters they stand for: decimal, hexadecimal and named ones of HTML 4."""
    named = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))])

    def of(part):
        name = F.regexp_extract(part, r"^([a-zA-Z][a-zA-Z0-9]*|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});", 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 7)).cast("int")
        # in the basic plane, without the halves of pairs
        char = F.when((number < 0xD800) | ((number > 0xDFFF) & (number < 0x10000)), F.decode(F.unhex(F.lpad(F.hex(number), 4, "0")), "UTF-16BE"))
        return F.when(name == "", F.concat(F.lit("&"), part)).otherwise(F.concat(F.coalesce(char, F.try_element_at(named, name), F.lit(" ")), F.substring(part, F.length(name) + 2, F.length(part))))

    parts = F.split(text, "&")
    joined = F.array_join(F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), of)), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def visible(html):
    """Text of a page without scripts, styles, navigation, comments and tags."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style|nav|head|header|footer|aside)\b.*?</\1\s*>|<!--.*?-->", " ")
    return _entities(F.regexp_replace(bare, r"(?s)<[^>]*>", " "))


def word_model(docs: DataFrame) -> DataFrame:
    """lang, word, n: counts of all words of all languages."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text")
    counts = known.select("lang", F.explode(_words(F.col("text").cast("string"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    return written(counts, "counts")


def _counted(words):
    """The distinct words of an array, each with the root of its count, by runs of the sorted array."""
    return F.transform(F.array(F.sort_array(words)), _runs)[0]


def _runs(words):
    last = F.filter(F.transform(words, lambda w, i: F.when(F.coalesce(F.get(words, i + 1) != w, F.lit(True)), i + 1)), lambda e: e.isNotNull())
    return F.transform(F.array(last), lambda ends: F.transform(ends, lambda e, j: F.struct(F.get(words, e - 1).alias("word"), F.sqrt(e - F.coalesce(F.get(ends, j - 1), F.lit(0))).alias("n"))))[0]


def word_weights(counts: DataFrame, totals: DataFrame, total: int) -> DataFrame:
    """word, all_n, by: for each language that has the word its weight, as text_scores() says."""
    weighed = counts.join(F.broadcast(totals), "lang").select("word", "n", F.struct("lang", F.log1p(F.col("n") * float(total) / F.col("size")).alias("weight")).alias("x"))
    return written(weighed.groupBy("word").agg(F.sum("n").alias("all_n"), F.collect_list("x").alias("by")), "words")


def text_scores(seen: DataFrame, model: DataFrame, total: int) -> DataFrame:
    """row, by: for each language the log likelihood of a page's words, less what is the same for all languages.

    A word's share of a language is smoothed by one occurrence dealt as the languages' sizes are:
    (n / size + 1 / total) / (all_n + 1); logs of 1 + n * total / size are left when common factors go.
    """
    often = F.col("all_n") * HOT_WORDS >= total  # HOT_WORDS words at most
    hot, rest = F.broadcast(model.where(often).drop("all_n")), model.where(~often).drop("all_n")
    found = seen.join(hot, "word").unionByName(seen.join(F.broadcast(model.where(often).select("word")), "word", "left_anti").join(rest, "word"))
    sums = found.select("row", "n", F.explode("by").alias("x")).groupBy("row", F.col("x.lang").alias("lang")).agg(F.sum(F.col("n") * F.col("x.weight")).alias("score"))
    return sums.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("lang", "score"))).alias("by"))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, probability: the best language of each page."""
    counts = word_model(docs)
    totals = written(counts.groupBy("lang").agg(F.sum("n").alias("size")), "sizes")
    total = totals.agg(F.sum("size").alias("n")).head()["n"]
    rows = pages.select("page_id", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://([^/:?#]+)", 1)).alias("host"), F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://[^/]+/([a-zA-Z]{2})/", 1)).alias("path_lang"), F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html[^>]*\blang=[\"']?([a-zA-Z]{2})", 1)).alias("declared"), _words(visible(F.col("html"))).alias("words"))
    if not total:
        return rows.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"))
    model = word_weights(counts, totals, total)
    drop_written(counts)
    # a word that a page repeats counts by the root of its count
    keyed = written(rows.withColumn("words", _counted(F.col("words"))).withColumn("row", F.monotonically_increasing_id()), "pages")
    seen = keyed.select("row", F.explode("words").alias("w")).select("row", "w.word", "w.n")
    langs = F.array(*[F.lit(r["lang"]) for r in totals.select("lang").orderBy("lang").collect()])  # as many as there are languages
    scored = keyed.drop("words").join(text_scores(seen, model, total), "row", "left")
    scores = F.when(F.col("by").isNotNull(), F.transform(langs, lambda x: F.coalesce(F.try_element_at("by", x), F.lit(0.0)))).otherwise(F.transform(langs, lambda x: F.lit(0.0)))
    add = lambda a, x: a + x
    scored = scored.withColumn("langs", langs).withColumn("worded", F.col("by").isNotNull()).withColumn("scores", scores).drop("by")
    scored = scored.withColumn("odds", F.transform("scores", lambda s: F.exp(s - F.array_max("scores")))).withColumn("norm", F.aggregate("odds", F.lit(0.0), add))
    scored = scored.withColumn("shares", F.transform("odds", lambda x: x / F.col("norm"))).drop("odds", "norm")

    def agreed(column: str):
        """The share of the text's posterior that a declaration gets; null where it says nothing."""
        at = F.array_position("langs", F.col(column))
        return F.when(F.col("worded") & (at > 0), F.get("shares", (at - 1).cast("int")))

    scored = scored.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)).withColumn("suffix", F.regexp_extract("host", r"([^.]+)$", 1))
    scored = written(scored.withColumn("declared_ok", agreed("declared")).withColumn("path_ok", agreed("path_lang")), "text-scores")
    drop_written(model, keyed)
    hosts = _levels(scored, langs)
    joined = scored.join(hosts, "host")

    def says(column: str, true, x):
        sure = F.least(F.greatest(true, F.lit(LEAST_TRUE)), F.lit(MOST_TRUE))
        wrong = F.log((1 - sure) / F.greatest(F.size("langs") - 1, F.lit(1)))
        return F.when(F.array_contains("langs", F.col(column)), F.when(F.col(column) == x, F.log(sure)).otherwise(wrong)).otherwise(F.lit(0.0))

    fused = F.transform("langs", lambda x, i: F.get("scores", i) + says("declared", F.col("declared_true"), x) + says("path_lang", F.col("path_true"), x) + F.log(F.get("prior", i)))
    joined = joined.withColumn("fused", fused).withColumn("most", F.array_max("fused"))
    place = F.array_position("fused", F.col("most")).cast("int")
    whole = F.aggregate(F.transform("fused", lambda v: F.exp(v - F.col("most"))), F.lit(0.0), add)
    return joined.select("page_id", F.get("langs", place - 1).alias("lang"), (1.0 / whole).alias("probability"))


def _levels(scored: DataFrame, langs) -> DataFrame:
    """host, prior (an array as langs), declared_true, path_true: each level smoothed towards the one above.

    Sums of a level are sums of the rows of the level below, hosts first, which are aggregated before they are shuffled."""
    worth = F.when(F.col("worded"), F.lit(1.0)).otherwise(F.lit(0.0))
    n_langs = F.size(langs)
    parts = {"d": "declared_ok", "p": "path_ok"}
    counted = [F.sum(worth).alias("n"), *[f for k, c in parts.items() for f in (F.count(c).cast("double").alias(f"{k}n"), F.coalesce(F.sum(c), F.lit(0.0)).alias(f"{k}s"))]]
    by_lang = scored.select("host", "domain", "suffix", F.posexplode("shares").alias("i", "share"), worth.alias("worth")).groupBy("host", "domain", "suffix", "i").agg(F.sum(F.col("share") * F.col("worth")).alias("h"))
    by_host = by_lang.groupBy("host", "domain", "suffix").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "h"))), lambda x: x["h"]).alias("h"))
    sums = written(scored.groupBy("host", "domain", "suffix").agg(*counted).join(by_host, ["host", "domain", "suffix"]), "hosts")
    names = ["n", "dn", "ds", "pn", "ps"]

    def level(keys: list[str], below: DataFrame, name: str) -> DataFrame:
        """Sums of a level, and of its shares by language."""
        flat = below.select(*keys, *names, F.posexplode("h").alias("i", "x"))
        per = flat.groupBy(*keys, "i").agg(F.sum("x").alias("x"), *[F.sum(c).alias(c) for c in names])
        return per.groupBy(*keys).agg(*[F.first(c).alias(c + name) for c in names], F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda y: y["x"]).alias("h" + name))

    suffixes, domains = level(["suffix"], sums, "_s"), level(["domain"], sums, "_m")
    every = level([], sums, "_w").head()  # one row with a number for each language, if there is a page
    known = {c: (every[c + "_w"] if every else None) or 0 for c in names}
    h_all = F.array(*map(F.lit, (every["h_w"] if every else None) or [0.0]))
    rows = sums.join(domains, "domain").join(suffixes, "suffix")

    def smooth(total, n, above):
        return (total + SMOOTHING * above) / (n + SMOOTHING)

    def true(k: str):
        whole = F.lit(smooth(known[f"{k}s"], known[f"{k}n"], DECLARED_TRUE))
        suffix = smooth(F.col(f"{k}s_s"), F.col(f"{k}n_s"), whole)
        return smooth(F.col(f"{k}s"), F.col(f"{k}n"), smooth(F.col(f"{k}s_m"), F.col(f"{k}n_m"), suffix))

    def prior(x, i):
        whole = smooth(F.get(h_all, i), F.lit(known["n"]), 1.0 / n_langs)
        suffix = smooth(F.get("h_s", i), F.col("n_s"), whole)
        return smooth(x, F.col("n"), smooth(F.get("h_m", i), F.col("n_m"), suffix))

    return rows.select("host", F.transform("h", prior).alias("prior"), true("d").alias("declared_true"), true("p").alias("path_true"))
