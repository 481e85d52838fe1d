"""The registered queries, whole tables of the smallest size, against brute force; each stage of the pipeline alone."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablelift.llm import bpe, jaccard_join, language_id, packing, quality_classifier, quality_rules, substring_dedup, toxicity, workload
from tablelift.llm.labelled import LONGEST

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def read(name):
    return pd.read_parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="module")
def docs():
    return [(int(r.doc_id), r.text if isinstance(r.text, str) else None) for r in read("documents").itertuples()]


@pytest.fixture(scope="module")
def ids(docs):
    t = Tokenizer.from_file(PATH)
    return {i: [*t.encode(x or "", add_special_tokens=False).ids, 2] for i, x in docs}


def run(spark, name):
    return workload.queries()[name](spark, SF).toPandas()


def crc(tokens):
    return zlib.crc32(np.array(tokens, "<u4").tobytes())


def test_op1(spark, ids):
    got = run(spark, "op1_best_fit_packing")
    want = set()
    for doc, tokens in ids.items():
        start = piece = 0
        first = (len(tokens) - 1) % 1024 + 1
        for stop in range(first, len(tokens) + 1, 1024):
            want.add((doc, piece, start, stop - start, crc(tokens[start:stop])))
            start, piece = stop, piece + 1
    assert {tuple(r) for r in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)} == want and len(got) == len(want)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= 1024 and (s.offset == s.length.cumsum() - s.length).all()
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 1024) + 2


def test_genetic_algorithm_beats_its_seeds():
    """Triplets that fill a sequence exactly."""
    rng = np.random.default_rng(1)
    lengths = []
    for _ in range(300):
        a = int(rng.integers(256, 500))
        b = int(rng.integers(256, 1024 - a - 256 + 1)) if a < 512 else 256
        lengths += [a, b, 1024 - a - b]
    block = packing.Block(np.array(lengths), 1024, 3)
    seeds = block.first()
    found = block.breed(seeds, packing.GENERATIONS)[0]
    assert (block.fill(found) <= 1024).all() and len(found) == 900
    assert block.cost(found)[0] <= 306 < 330 <= min(block.cost(s)[0] for s in seeds)


def fold(doc, n):
    return zlib.crc32(str(doc).encode()) % n


def labelled(docs, label, folds, held):
    labels = read("labels")
    known = {int(r.doc_id): int(getattr(r, label)) for r in labels.itertuples() if fold(r.doc_id, folds) != held and not pd.isna(getattr(r, label))}
    texts = {}
    for i, t in sorted(docs):
        if i in known and t is not None and len(t.encode()) <= LONGEST:
            texts.setdefault(t, known[i])
    return list(texts), np.array(list(texts.values()), float)


@pytest.mark.parametrize("name,module,label,folds,held", [("op2_quality_classifier", quality_classifier, "quality", 4, 2), ("op10_toxicity", toxicity, "toxic", 3, 1)])
def test_op2_op10(spark, docs, name, module, label, folds, held):
    """Scores are those of a model that is fitted here, from all labels outside the fold."""
    texts, known = labelled(docs, label, folds, held)
    model = module.Model.fit(texts, known)
    got = run(spark, name).set_index("doc_id")
    assert len(got) == len(docs)
    want = model.score([(t or "").encode() for _, t in docs])
    assert np.allclose(got.score.loc[[i for i, _ in docs]], want, atol=1e-9)
    assert ((got.score >= 0.7) == (got.predicted == 1)).all() and all(got.held_out[i] == (fold(i, folds) == held) for i in got.index)


@pytest.mark.parametrize("name,label,folds,held", [("op2_quality_classifier", "quality", 4, 2), ("op10_toxicity", "toxic", 3, 1)])
def test_held_out_accuracy(spark, name, label, folds, held):
    """On a size where a thousand labels are held out."""
    got = workload.queries()[name](spark, "/root/testdata/sf0.1").toPandas().set_index("doc_id").predicted
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet").set_index("doc_id")[label]
    out = labels[[i for i in labels.index if fold(i, folds) == held]]
    guessed = got[out.index]
    assert len(out) > 900 and (guessed == out).mean() >= 0.97
    assert guessed[out == 1].mean() >= 0.85 and guessed[out == 0].mean() <= (0.01 if label == "toxic" else 0.06)


def test_op4(spark, docs):
    got = run(spark, "op4_substring_dedup").set_index("doc_id")
    least, want = {}, {}
    words = {i: WORD.findall(t or "") for i, t in docs}
    for i in sorted(words, reverse=True):
        for k in range(len(words[i]) - 12):
            least[tuple(words[i][k : k + 13])] = i
    for i, w in words.items():
        cut = [False] * len(w)
        for k in range(len(w) - 12):
            if least[tuple(w[k : k + 13])] < i:
                cut[k : k + 13] = [True] * 13
        want[i] = len(w), sum(cut), hashlib.sha256(" ".join(x for x, c in zip(w, cut, strict=True) if not c).encode()).hexdigest()
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.iterrows()} == want and any(n for _, n, _ in want.values())


def test_op4_hot_kmers(spark, monkeypatch):
    """A phrase of many contexts, passages of 13 words and more in many documents, and one document with itself."""
    rng = np.random.default_rng(9)
    phrase, passage = [f"p{i}" for i in range(8)], [f"q{i}" for i in range(16)]
    rows = []
    for d in range(120):
        w = [f"w{x}" for x in rng.integers(0, 40, 30)]
        rows.append((d % 110, " ".join([*w[:9], *phrase, *w[9:15], *passage[: 10 + d % 7], *w[15:], *phrase, *w[:9], *(w[:20] if d % 3 else [])])))
    rows += rows[5:70:2]  # the same rows again, in other slices
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for size in (1 << 9, 1 << 22):  # slices of a few texts, and of all
        monkeypatch.setattr(substring_dedup, "groups", lambda texts, most, size=size: __import__("tablelift.llm.shingles", fromlist=["groups"]).groups(texts, size))
        least, want = {}, []
        for i, t in rows:
            w = t.split()
            for k in range(len(w) - 12):
                key = tuple(w[k : k + 13])
                least[key] = min(least.get(key, 1 << 60), i)
        for i, t in rows:
            w = t.split()
            cut = [False] * len(w)
            for k in range(len(w) - 12):
                if least[tuple(w[k : k + 13])] < i:
                    cut[k : k + 13] = [True] * 13
            want.append((i, " ".join(x for x, c in zip(w, cut, strict=True) if not c)))
        assert sorted((r.doc_id, r.kept_text) for r in substring_dedup.dedup(table).collect()) == sorted(want)


def test_op4_collisions_are_found(spark, monkeypatch):
    """Hashes of a few bits collide; the digests at the source coordinates tell, and other hashes are tried."""
    tries = []
    real = substring_dedup._paths

    def weak(window, salt, part):
        tries.append(salt)
        if salt:
            return real(window, salt, part)
        inner = real(window, salt, part)

        def spoil(batches):
            for b in inner(batches):
                import pyarrow as pa

                n = b.num_rows
                edges = [None if e is None else b"\0" * len(e) for e in b["edges"].to_pylist()]
                yield pa.RecordBatch.from_arrays([b["kind"], pa.array([7] * n, pa.int64()), *[b[c] for c in ("doc", "tag", "at", "n")], pa.array(edges, pa.binary()), *[b[c] for c in ("x", "x_tag", "x_at")]], schema=b.schema)

        return spoil

    monkeypatch.setattr(substring_dedup, "_paths", weak)
    rows = [(i, " ".join(f"a{i}b{j}" for j in range(20))) for i in range(4)]
    got = substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.kept_text) for r in got) == rows and set(tries) == {0, 1000}


def test_op5(spark, ids):
    got = run(spark, "op5_token_files").set_index("doc_id")
    start = 0
    for i in sorted(ids):
        assert (got.start[i], got.n_tokens[i], got.ids_crc32[i]) == (start, len(ids[i]), crc(ids[i]))
        start += len(ids[i])


def shingles(text, k):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(docs, k, num, den):
    """Least key that links reach, for (key, text) rows."""
    sets = [(i, shingles(t, k)) for i, t in docs]
    root = {i: i for i, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and den * len(x & y) >= num * len(x | y):
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {i: (len(s), top(i)) for i, s in sets}


def test_op6(spark, docs):
    got = run(spark, "op6_jaccard_join")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == components(docs, 3, 9, 10)


def test_op7(spark, docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    true = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    got = run(spark, "op7_bpe_encoding").set_index("doc_id")
    for i, t in docs:
        tokens = true.encode_ordinary(t or "")
        assert (got.n_tokens[i], got.ids_sha256[i], got.decoded_sha256[i]) == (len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def rules(rows):
    """doc_id, text, lang rows to the verdicts of the quality rules, by the definitions."""
    out, langs = [], defaultdict(lambda: [0, np.zeros(5), np.zeros(5)])
    for doc, text, lang in rows:
        t = text or ""
        w = WORD.findall(t)
        windows = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        cover = {j + d for j in range(len(w) - 4) if windows[tuple(w[j : j + 5])] > 1 for d in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        chars = sum(map(len, w))
        few = [sum(c in letters for c in t) for _, letters in quality_rules.CLASSES]
        common = [sum(x in known for x in w) for known in quality_rules.COMMON.values()]
        characters, words = np.array([*few, chars - sum(few)], float), np.array([*common, len(w) - sum(common)], float)
        failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
        if not failed:
            held = langs[lang]
            held[0], held[1], held[2] = held[0] + 1, held[1] + characters, held[2] + words
        out.append((doc, lang, len(w), chars, few[2], len(lines) - len(set(lines)), len(cover), failed, characters, words))
    share = lambda x: x / x.sum()

    def distance(p, q):
        m = (p + q) / 2
        return math.sqrt(max(0.0, sum((a * math.log2(a / c) if a else 0) + (b * math.log2(b / c) if b else 0) for a, b, c in zip(p, q, m, strict=True)) / 2))

    enough = {k: (share(c), share(v)) for k, (n, c, v) in langs.items() if n >= quality_rules.LEAST_DOCS and c.sum() and v.sum()}
    references = {k: v for k, v in enough.items() if k is not None} or enough
    most = {k: distance(np.array([0, 0, 0, 0, 1.0]), v) for k, (_, v) in references.items()}
    verdicts = []
    for doc, lang, n, chars, symbols, dup, repeat, failed, characters, words in out:
        far = False
        if characters.sum() and references:
            far = min(distance(share(characters), c) for c, _ in references.values()) > quality_rules.MAX_CHARACTERS
        told = [k for k in references if most[k] >= quality_rules.LEAST_SIGNAL]
        if words.sum() and told and not (lang in references and most[lang] < quality_rules.LEAST_SIGNAL):
            far |= min(distance(share(words), references[k][1]) / most[k] for k in told) > quality_rules.MAX_WORDS_SHARE
        verdicts.append((doc, n, chars, symbols, dup, repeat, failed, not failed and (n < quality_rules.MIN_WORDS or not far)))
    return verdicts


def test_op8(spark):
    rows = [(int(r.doc_id), r.text if isinstance(r.text, str) else None, r.lang) for r in read("documents").itertuples()]
    got = run(spark, "op8_quality_rules")
    want = rules(rows)
    assert sorted(tuple(r) for r in got.itertuples(index=False)) == sorted(want)
    assert 0 < sum(r[-1] for r in want) < len(want)


def test_op8_compiles(spark):
    """With forty languages the generated classes stay within the limits of the virtual machine."""
    plain = " ".join([*quality_rules.COMMON["en"], "river", "stone", "garden", "winter"] * 5)
    rows = [(i, f"{plain} word{i} word{i * 7}", f"l{i % 40}", 1) for i in range(800)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, rule_row int")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        kept = quality_rules.keep(table)
        assert kept.columns == table.columns and len(kept.collect()) == quality_rules.judged(table).where("kept").count()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def languages(pages, docs):
    """The fused evidence by its definition: best language and probability of each (id, url, html)."""
    split = lambda t: [w for w in re.split(r"[\W\d_]+", t.lower()) if w]
    n = defaultdict(Counter)
    for _, t, lang in docs:
        if t is not None and lang is not None:
            n[lang].update(split(t))
    langs = sorted(n)
    size = {k: sum(n[k].values()) for k in langs}
    total = sum(size.values())
    rows = []
    for page, url, html in pages:
        first = lambda p, t: (re.search(p, t) or [None, ""])[1].lower()
        bare = re.sub(r"(?is)<(script|style|nav|head|header|footer|aside)\b.*?</\1\s*>|<!--.*?-->", " ", html or "")
        import html as entities

        words = Counter(split(entities.unescape(re.sub(r"(?s)<[^>]*>", " ", bare))))
        known = {w: c for w, c in words.items() if any(w in n[k] for k in langs)}
        scores = np.array([sum(math.sqrt(c) * math.log1p(n[k][w] * total / size[k]) for w, c in known.items()) for k in langs])
        share = np.exp(scores - scores.max())
        host = first(r"^[a-zA-Z]+://([^/:?#]+)", url or "")
        rows.append((page, host, (re.search(r"([^.]+\.[^.]+)$", host) or [0, ""])[1], (re.search(r"([^.]+)$", host) or [0, ""])[1], first(r"(?i)<html[^>]*\blang=[\"']?([a-zA-Z]{2})", html or ""), first(r"^[a-zA-Z]+://[^/]+/([a-zA-Z]{2})/", url or ""), bool(known), scores, share / share.sum()))
    smooth = lambda s, k, above: (s + language_id.SMOOTHING * above) / (k + language_id.SMOOTHING)

    def levels(row, value, above):
        for keys in ((), (3,), (2,), (1,)):
            same = [value(r) for r in rows if all(r[k] == row[k] for k in keys)]
            same = [v for v in same if v is not None]
            above = smooth(sum(same), len(same), above)
        return above

    out = []
    for r in rows:
        prior = levels(r, lambda x: x[8] if x[6] else None, np.full(len(langs), 1 / len(langs)))
        fused = r[7] + np.log(prior)
        for c in (4, 5):
            if r[c] in langs:
                true = levels(r, lambda x, c=c: x[8][langs.index(x[c])] if x[6] and x[c] in langs else None, language_id.DECLARED_TRUE)
                true = min(max(true, language_id.LEAST_TRUE), language_id.MOST_TRUE)
                fused = fused + np.array([math.log(true) if k == r[c] else math.log((1 - true) / (len(langs) - 1)) for k in langs])
        best = int(fused.argmax())
        out.append((r[0], langs[best], 1 / np.exp(fused - fused[best]).sum()))
    return out


def compare_languages(got, want):
    got = sorted((r.page_id, r.lang, r.probability) for r in got)
    assert [r[:2] for r in got] == [r[:2] for r in sorted(want)] and np.allclose([r[2] for r in got], [r[2] for r in sorted(want)], rtol=1e-6)


def test_op9(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in read("documents").itertuples()]
    got = run(spark, "op9_language_id")
    compare_languages(got.itertuples(), languages([tuple(r) for r in read("pages")[["page_id", "url", "html"]].itertuples(index=False)], docs))


def test_op9_declarations_are_counted(spark):
    """A host that declares English on French pages is not believed on its page without words; one that is right is."""
    docs = [(i, "the river and the stone of it was here", "en") for i in range(5)] + [(9, "le fleuve et la pierre de lui &eacute; été ici", "fr")]
    french, english = "le fleuve et la pierre de lui &eacute;t&#233;", "the river and the stone"
    pages = [(i, f"http://wrong.org/x/{i}", f"<html lang='en'><p>{french}</p></html>") for i in range(40)]
    pages += [(100 + i, f"http://right.com/x/{i}", f"<html lang='en'><p>{english}</p></html>") for i in range(40)]
    pages += [(200, "http://wrong.org/x/y", "<html lang='en'></html>"), (201, "http://right.com/x/y", "<html lang='en'></html>"), (202, None, None), (203, "http://other.net/fr/1", ""), (203, "http://other.net/fr/1", "")]
    got = language_id.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    compare_languages(got, languages(pages, docs))
    best = {r.page_id: r.lang for r in got}
    assert best[200] == "fr" and best[201] == "en" and best[203] == "fr"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_automata_against_edit_distance():
    rng = np.random.default_rng(8)
    word = lambda n: "".join(rng.choice(list("abc"), n))
    terms = {word(n) for n in (3, 4, 5, 6, 7) for _ in range(4)}
    lexicon = toxicity.Lexicon(terms, set(), set(), set())
    for _ in range(4000):
        w = word(int(rng.integers(1, 9)))
        exact = w in terms
        near = any(len(t) >= toxicity.LONG and distance(w, t) <= 1 for t in terms)
        assert lexicon.match(w) == (1.0 if exact else 0.9 if near else 0.0), w
    stems = toxicity.Lexicon(set(), {"abca"}, set(), set())
    assert stems.match("abcaxyz") == 1.0 and stems.match("abc") == 0.0


def test_quotation_and_address():
    model = toxicity.Model(toxicity.Lexicon({"dreadful"}, set(), set(), set()), 0.5)
    weight = lambda t: model.matches(t)[0][2]
    assert weight("it is dreadful here") == 1.0 and weight("parle du dreadful fleuve") == 1.0
    assert weight("you are dreadful") == toxicity.ABUSE and weight("he said dreadful things") == toxicity.MENTION
    for quoted in ('a "dreadful" thing', "a “very dreadful old” thing", "«un dreadful mot»", 'they wrote "a dreadful, dull day."'):
        assert weight(quoted) == toxicity.MENTION, quoted
    assert weight('"one" dreadful "two"') == 1.0 and weight('an open " dreadful mark') == 1.0


# stages of the pipeline

KIND = "doc_id long, text string, lang string, source string, n_chars long, n_removed string, kept_text int, rule_row long, near_row string, c0 int"
PROSE = " ".join(f"word{i * 7 % 101} the of and{i % 13}" for i in range(60))
OTHER = " ".join(f"stone{i * i % 89} is it to{i % 11}" for i in range(70))


def stage_table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", 1, 5, None, 3) for i, t in rows], KIND)


ODD = [(1, PROSE), (1, PROSE), (2, PROSE + " one more"), (3, OTHER), (None, OTHER), (4, None), (5, ""), (6, None), (7, "a b"), (8, "x " * 500), (9, PROSE[:300] + " " + OTHER[:300]), (10, " ".join(f"own{i}" for i in range(2000)))]


def same_rows(frame, rows):
    assert sorted((str(r.doc_id), str(r.text), r.n_removed, r.rule_row, r.c0) for r in frame.collect()) == sorted((str(i), str(t), "x", 5, 3) for i, t in rows)


def test_stage_quality_rules(spark):
    table = stage_table(spark, ODD)
    got = corpus_pipeline.quality_rules_stage(spark, table, SF)
    assert got.columns == table.columns
    verdict = rules([(n, t, "en") for n, (_, t) in enumerate(ODD)])
    same_rows(got, [row for row, v in zip(ODD, verdict, strict=True) if v[-1]])
    assert corpus_pipeline.quality_rules_stage(spark, stage_table(spark, []), SF).count() == 0


def test_stage_quality_classifier(spark, tmp_path):
    rng = np.random.default_rng(1)
    good = [(i, " ".join(rng.choice(["river", "stone", "light", "the", "of", "garden"], 60))) for i in range(60)]
    bad = [(100 + i, " ".join(rng.choice(["BUY!!", "WIN$$", "|||", "###"], 60))) for i in range(60)]
    odd = [(None, "the river of stone " * 9), (300, None), (301, ""), (7, good[7][1]), (302, "WIN$$ " * 3000)]
    table = stage_table(spark, good + bad + odd)
    spark.createDataFrame([(i, int(i < 100), 0) for i, _ in good + bad] + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.quality_classifier_stage(spark, table, str(tmp_path))
    assert got.columns == table.columns
    texts, labels = [t for _, t in sorted(good + bad)], np.array([float(i < 100) for i, _ in sorted(good + bad)])
    unique = dict(zip(reversed(texts), reversed(labels), strict=True))
    model = quality_classifier.Model.fit(list(dict.fromkeys(texts)), np.array([unique[t] for t in dict.fromkeys(texts)]))
    scores = model.score([(t or "").encode() for _, t in good + bad + odd])
    same_rows(got, [r for r, s in zip(good + bad + odd, scores, strict=True) if s >= corpus_pipeline.LEAST_QUALITY])
    assert corpus_pipeline.quality_classifier_stage(spark, stage_table(spark, []), str(tmp_path)).count() == 0


def first_of_components(rows):
    linked = components(list(enumerate(t for _, t in rows)), 5, 8, 10)
    best = {}
    for n, (doc, _) in enumerate(rows):
        key = (doc is None, doc or 0)
        best.setdefault(linked[n][1], []).append((key, n))
    return [min(v) for v in best.values()], best


def test_stage_near_duplicates(spark):
    table = stage_table(spark, ODD)
    got = corpus_pipeline.near_duplicates_stage(spark, table, SF)
    assert got.columns == table.columns
    chosen, _ = first_of_components(ODD)
    same_rows(got, [ODD[n] for _, n in chosen])
    assert corpus_pipeline.near_duplicates_stage(spark, stage_table(spark, []), SF).count() == 0


def cut_texts(rows):
    least, out = {}, []
    for doc, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            least[key] = min(least.get(key, 1 << 62), 1 << 61 if doc is None else doc)
    for doc, t in rows:
        w = WORD.findall(t or "")
        cut = [False] * len(w)
        for k in range(len(w) - 12):
            if least[tuple(w[k : k + 13])] < (1 << 61 if doc is None else doc):
                cut[k : k + 13] = [True] * 13
        if not any(cut):
            out.append((doc, t))
        elif not all(cut):
            out.append((doc, " ".join(x for x, c in zip(w, cut, strict=True) if not c)))
    return out


def test_stage_substring_dedup(spark):
    table = stage_table(spark, ODD)
    got = corpus_pipeline.substring_dedup_stage(spark, table, SF)
    assert got.columns == table.columns and got.schema["n_chars"].dataType == table.schema["n_chars"].dataType
    same_rows(got, cut_texts(ODD))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())
    assert corpus_pipeline.substring_dedup_stage(spark, stage_table(spark, []), SF).count() == 0


def test_stage_packing(spark):
    got = corpus_pipeline.packing_stage(spark, stage_table(spark, ODD), SF).toPandas()
    t = Tokenizer.from_file(PATH)
    assert got.length.sum() == sum(len(t.encode(x or "", add_special_tokens=False).ids) + 1 for _, x in ODD)
    assert got.groupby("sequence_id").length.sum().max() <= 1024 and (got.piece == 0).sum() == len(ODD)
    assert corpus_pipeline.packing_stage(spark, stage_table(spark, []), SF).count() == 0


def test_pipeline(spark, docs):
    """All stages, one after the other, on a whole table."""
    rows = [(int(r.doc_id), r.text if isinstance(r.text, str) else None, r.lang) for r in read("documents").itertuples()]
    kept = [r for r, v in zip(rows, rules(rows), strict=True) if v[-1]]
    known = {int(r.doc_id): int(r.quality) for r in read("labels").itertuples() if not pd.isna(r.quality)}
    texts = {}
    for i, t, _ in sorted(kept):
        if i in known and len(t.encode()) <= LONGEST:
            texts.setdefault(t, known[i])
    model = quality_classifier.Model.fit(list(texts), np.array(list(texts.values()), float))
    scores = model.score([t.encode() for _, t, _ in kept])
    good = [(i, t) for (i, t, _), s in zip(kept, scores, strict=True) if s >= corpus_pipeline.LEAST_QUALITY]
    single = [good[n] for _, n in first_of_components(good)[0]]
    last = cut_texts(single)
    t = Tokenizer.from_file(PATH)
    want = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in last}
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == want and len(rows) > len(kept) > 0 and len(good) > len(single) > 0
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "substring_dedup", "best_fit_packing"]


def test_chunks_are_encoded_as_whole_texts():
    """Odd white space, marks, contractions, special strings and long words, in slices of several texts."""
    from tablelift.llm.tokens import Encoder

    mine, library = Encoder(PATH), Tokenizer.from_file(PATH)
    rng = np.random.default_rng(11)
    odd = [*" " * 8, "  ", "\n", "\n\n", "\t", "\r\n", " ", "　", " ", "\u0085", "\x1f", "​", " ", "\x0b", "a", "the", "Word", "é", "中", "1", "23", *"!'(),-.:;?_/", "'s", "'LL", "'ve", "don't", "…", "’", "😀", "<|endoftext|>", "<|", "x" * 70, "ß"]
    texts = ["".join(rng.choice(odd, int(rng.integers(0, 25)))) for _ in range(6000)] + ["".join(map(chr, rng.integers(1, 128, 30))) for _ in range(3000)] + ["", "", " ", "\n"]
    for _ in range(2):
        ids, counts = mine.encode([t.encode() for t in texts])
        ends = np.cumsum(counts)
        for t, s, e in zip(texts, ends - counts, ends, strict=True):
            assert ids[s:e].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
        texts = texts[::-1]


@pytest.mark.parametrize("k,num,den", [(3, 9, 10), (5, 8, 10), (2, 3, 4)])
def test_no_link_is_missed(k, num, den):
    """Two sets just above the threshold always share a token, whatever differs and however small they are."""
    rng = np.random.default_rng(k)
    tried = 0
    for _ in range(6000):
        common = int(rng.integers(1, 90))
        most = common * den // num - common
        a = int(rng.integers(0, most + 1))
        x, y, z = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (common, a, most - a))
        one, other = np.unique(np.concatenate([x, y])), np.unique(np.concatenate([x, z]))
        assert den * len(np.intersect1d(one, other)) >= num * len(np.union1d(one, other))
        tried += 1
        assert len(np.intersect1d(jaccard_join._tokens(one, num, den), jaccard_join._tokens(other, num, den))), (len(one), len(other))
    assert tried == 6000


def test_spans_of_overlapping_paths(spark):
    """Paths of repeated rows overlap in many ways; spans are what they cover together."""
    rng = np.random.default_rng(6)
    rows, want = [], set()
    for doc in range(60):
        for shift in (3, -1):
            cover = np.zeros(80, int)
            for _ in range(int(rng.integers(1, 9))):
                at, n = int(rng.integers(1, 60)), int(rng.integers(1, 12))
                rows += [(doc, 1, at, n, 5, 7, at + shift)] * int(rng.integers(1, 3))
                cover[at : at + n] = 1
            edge = np.flatnonzero(np.diff(np.concatenate([[0], cover, [0]])))
            # paths that only touch are one span too
            want |= {(doc, 1, int(s), int(e - s), 5, 7, int(s) + shift) for s, e in zip(edge[0::2], edge[1::2], strict=True)}
    table = spark.createDataFrame(rows, "doc long, tag long, at int, n int, x long, x_tag long, x_at int")
    assert {tuple(r) for r in substring_dedup._spans(table).select("doc", "tag", "at", "n", "x", "x_tag", "x_at").collect()} == want
