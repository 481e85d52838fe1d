"""Every operator on a small table with nulls, empty and long texts, ties, repeated rows and odd columns."""

import hashlib
import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablelift.llm import bpe, jaccard_join, language_id, packing, quality_classifier, quality_rules, substring_dedup, token_files, toxicity, vector_search
from tablelift.llm.common import scratch_folders

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KIND = "doc_id long, text string, lang string, source string, n_chars long, word_chars string, piece int, h1 string"
PROSE = " ".join(f"word{i * 7 % 101} the of and{i % 13}" for i in range(60))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", 1, None) for i, t in rows], KIND)


def texts():
    rows = [(1, PROSE), (2, PROSE), (3, PROSE + " one more"), (4, None), (5, ""), (6, "a b"), (7, "A B"), (8, " \t\n "), (9, "é  ü\x85x \n y"), (10, "x " * 3000 + PROSE[:400]), (11, "short passage " + PROSE[100:300]), (None, PROSE), (2, PROSE), (12, "la la la la la la la la la la la la"), (13, "line\nline\n\nline two"), (14, "see <|endoftext|> here and<|endoftext|>\n<|endoftext|> "), (15, "<|endoftext|>")]
    return rows + [(20 + i, " ".join(f"w{(i * 31 + j * j) % 97}" for j in range(40 + 25 * i))) for i in range(20)]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, texts())


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


PATH = public_tokenizers.path("byte_bpe_50k.json")


def true_ids(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2]


def test_packing(docs, none):
    got = packing.pack(packing.pieces_of(docs, PATH)).toPandas()
    assert got.groupby("sequence_id").length.sum().max() <= 1024
    ordered = got.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id").length.cumsum() - ordered.length == ordered.offset).all()
    want = sorted(len(true_ids(t)) for _, t in texts())
    assert sorted(got[got.piece == 0].length + 1024 * got[got.piece == 0].start) != [] and got.length.sum() == sum(want)
    assert got.sequence_id.nunique() <= -(-sum(want) // 1024) + 1
    assert packing.pack(packing.pieces_of(none, PATH)).count() == 0


def test_token_files(spark, docs, none, tmp_path):
    token_files.write_token_file(docs, str(tmp_path / "f"), PATH)
    got = {(r.doc_id, r.start): r for r in token_files.read_token_file(spark, str(tmp_path / "f")).collect()}
    order = sorted(texts(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, flat = 0, []
    for doc, text in order:
        ids = true_ids(text)
        assert bytes(got[doc, start].ids) == np.array(ids, "<u4").tobytes()
        start, flat = start + len(ids), flat + ids
    assert len(got) == len(order)
    for i in (0, 1, len(flat) // 2, len(flat) - 1):
        assert token_files.read_token(spark, str(tmp_path / "f"), i) == flat[i]
    token_files.write_token_file(none, str(tmp_path / "e"), PATH)
    assert token_files.read_token_file(spark, str(tmp_path / "e"), digest=True).count() == 0


def test_levels():
    for ids in ([], [0], [255, 256, 65535, 65536, 2**31], list(range(3000))):
        held = token_files.Levels.from_bytes(token_files.Levels.of(np.array(ids, np.uint32)).to_bytes())
        assert held.ids().tolist() == ids and [held.at(i) for i in range(len(ids))] == ids


def test_bpe(docs, none):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    true = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    extra = ["a" * 300, "ab" * 200 + "c", " " * 70, "<|endoftext|>", "don't  \n 12"]
    mine = bpe.loaded(path, public_tokenizers.PATTERN)
    for t, ids in zip(extra, mine.encode(extra), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == true.encode_ordinary(t) and mine.decode(ids) == t.encode()
    got = bpe.encode(docs, path, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in got) == sorted((str(i), np.array(true.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in texts())
    assert bpe.digests(none, path, public_tokenizers.PATTERN).count() == 0


def test_substring_dedup(docs, none):
    least, want = {}, []
    for i, t in texts():
        w = WORD.findall(t or "")
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            least[key] = min(least.get(key, 1 << 62), (1 << 61) if i is None else i)
    for i, t in texts():
        w = WORD.findall(t or "")
        cut = [False] * len(w)
        for k in range(len(w) - 12):
            if least[tuple(w[k : k + 13])] < ((1 << 61) if i is None else i):
                cut[k : k + 13] = [True] * 13
        want.append((str(i), len(w), sum(cut), " ".join(x for x, c in zip(w, cut) if not c)))
    got = substring_dedup.dedup(docs)
    assert {*docs.columns, "kept_text", "n_words", "n_removed"} - {"text"} == set(got.columns)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == sorted(want)
    assert substring_dedup.dedup(none).count() == 0


@pytest.mark.parametrize("k,num,den", [(3, 9, 10), (5, 8, 10)])
def test_jaccard_join(docs, none, k, num, den):
    sets = []
    for _, t in texts():
        w = [x.lower() if x.isascii() else x for x in WORD.findall(t or "")]
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(sets)))
    for _ in sets:
        for a in range(len(sets)):
            for b in range(a):
                if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    ids = [i for i, _ in texts()]
    want = []
    for a, i in enumerate(ids):
        known = [ids[b] for b in range(len(ids)) if root[b] == root[a] and ids[b] is not None]
        want.append((str(i), len(sets[a]), str(min(known) if known and sets[a] else i)))
    got = [(str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.join(docs, k, num, den).collect()]
    assert sorted(got) == sorted(want)
    assert jaccard_join.join(none).count() == 0


def test_jaccard_join_keeps_no_table_that_it_has_read(spark):
    """What is on disk at once: a range of tokens is read from its own column, and tables go when nothing reads them any more."""
    tokens = np.random.default_rng(5).integers(0, 1 << 63, 60_000, dtype=np.uint64)
    ranges = jaccard_join._ranges(tokens)
    assert sorted(np.concatenate(ranges).view(np.uint64).tolist()) == sorted(tokens.tolist())
    assert max(map(len, ranges)) < len(tokens) / 8
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[: 40 + i % 7], f"x{i % 5}", *words[50:]])) for i in range(40)]
    before = scratch_folders()
    found = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 8, 10)
    left = {re.search(r"/tablelift-([^/]+)-[0-9a-f]{32}$", p)[1] for p in scratch_folders() - before}
    assert left <= {"classes", "sets", "labels"} and found.count() == 40


@pytest.mark.parametrize("group", [2, 64])
def test_jaccard_join_of_chains_and_shared_passages(spark, monkeypatch, group):
    """Chains of near copies (the ends are no near copies), and a passage that many other documents share."""
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    passage = [f"p{i}" for i in range(60)]
    words = [[f"c{c}x{i}" for i in range(step * 4, step * 4 + 100)] for c in range(3) for step in range(15)]
    words += [[*passage, *(f"o{d}y{i}" for i in range(d % 40))] for d in range(60)]
    sets = [{tuple(w[j : j + 3]) for j in range(len(w) - 2)} for w in words]
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    docs = table(spark, list(enumerate(" ".join(w) for w in words)))
    got = {r.doc_id: r.component_id for r in jaccard_join.join(docs).collect()}
    assert got == {i: top(i) for i in range(len(sets))}


def test_quality_rules(docs, none):
    got = {(str(r.doc_id), r.n_words): r for r in quality_rules.judged(docs).collect()}
    for i, t in texts():
        t = t or ""
        w = WORD.findall(t)
        windows = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
        cover = set()
        for j, x in enumerate(windows):
            if windows.count(x) > 1:
                cover |= set(range(j, j + 5))
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = got[str(i), len(w)]
        want = (sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert (r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w)) and not (r.base_failed and r.kept)
    assert quality_rules.judged(none).count() == 0
    assert quality_rules.keep(docs).columns == docs.columns


def test_quality_rules_reject_clean_letters_without_common_words(spark):
    rng = np.random.default_rng(5)
    common = {k: rng.permutation(v).tolist() for k, v in quality_rules.COMMON.items()}

    def text(lang, share):
        return " ".join(rng.choice(common[lang]) if rng.random() < share else "".join(rng.choice(list("abcdeghilmnorstu"), 7)) for _ in range(200))

    rows = [(i, text(lang, share), lang) for i, (lang, share) in enumerate((lang, share) for lang in common for share in (0.3, 0.2, 0.15) for _ in range(15))]
    rows += [(1000 + i, text(lang, 0.0), lang) for i, lang in enumerate(common)]
    # words of no list: nothing is known of such a language, so that its documents are not tested by words
    rows += [(3000 + i, text("en", 0.0), "xx") for i in range(30)]
    got = {r.doc_id: r.kept for r in quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [i for i, _, _ in rows if not got[i]] == [1000, 1001, 1002, 1003]


def test_quality_rules_references(spark):
    """More than 32 languages, the last with characters of its own; junk alone under its language or without one."""
    rng = np.random.default_rng(6)
    plain = lambda n: " ".join(rng.choice([*quality_rules.COMMON["en"], "river", "stone", "garden", "winter"], n))
    digits = lambda: " ".join("".join(rng.choice(list("0123456789"), 6)) for _ in range(60))
    rows = [(i, plain(60), f"l{i % 34:02}") for i in range(34 * 20)]
    rows += [(1000 + i, digits() + " the of and to in is that it", "zz") for i in range(12)]
    rows += [(2000, digits(), "alone"), (2001, digits(), None), (2002, plain(60), "rare"), (2003, plain(60), None)]
    got = {r.doc_id: r.kept for r in quality_rules.judged(spark.createDataFrame(rows[: 34 * 20] + rows[-4:], "doc_id long, text string, lang string")).collect()}
    assert [i for i in got if not got[i]] == [2000, 2001]
    got = {r.doc_id: r.kept for r in quality_rules.judged(spark.createDataFrame(rows[:-4], "doc_id long, text string, lang string")).collect()}
    assert all(got[1000 + i] for i in range(12))


def test_vector_search(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(300 + i, [1.0] * 8) for i in range(30)]
    bad = [(901, None), (902, [1.0, None]), (903, [float("nan")] * 8), (950, [float("inf")] * 8), (904, [])]
    got = vector_search.top_k(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).repartition(5)).collect()
    vectors = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64) for i, v in rows} | {904: np.zeros(8, np.int64)}
    want = []
    for q in (i for i in vectors if i % 50 == 0):
        order = sorted((-int(vectors[q] @ x), i) for i, x in vectors.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(order)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert vector_search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    # rows with one vec_id are candidates of each other
    twins = spark.createDataFrame([(0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [3.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in vector_search.top_k(twins).collect()) == [(0, 1, 1, 256 * 768), (0, 1, 1, 512 * 768), (0, 2, 0, 256 * 512), (0, 2, 0, 256 * 512)]


def test_vector_search_prunes_clusters(spark, monkeypatch):
    """Clusters far apart: most annuli stay closed, and the result is that of all pairs."""
    monkeypatch.setattr(vector_search, "CELL_ROWS", 16)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 6)) * 20
    x = np.floor(256 * (np.repeat(centres, 80, axis=0) + rng.normal(size=(960, 6)) * 0.2).astype(np.float32).astype(float)).astype(np.int64)
    counts = {}
    got = vector_search.top_k(spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), counts=counts).collect()
    scores = x @ x.T
    want = []
    for q in range(0, 960, 50):
        order = sorted((-int(s), i) for i, s in enumerate(scores[q]) if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(order)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert counts["opened"] < 0.6 * counts["cells"] * counts["queries"]


def test_classifiers(spark, docs, none):
    rng = np.random.default_rng(1)
    good = [(i, " ".join(rng.choice(["river", "stone", "light", "the", "of", "garden"], 60))) for i in range(80)]
    bad = [(100 + i, " ".join(rng.choice(["BUY!!", "WIN$$", "|||", "###"], 60))) for i in range(80)]
    toxic = [(200 + i, " ".join(rng.choice(["river", "stone", "light", "the", "of"], 30)) + " " + rng.choice(["dreadfulo", "horridax"])) for i in range(80)]
    labels = spark.createDataFrame([(i, int(i < 100), int(i >= 200)) for i, _ in good + bad + toxic] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    every = table(spark, good + bad + toxic)
    learn = lambda c: c % 2 == 0
    model = quality_classifier.fit(every, labels, learn)
    got = {r.doc_id: r.score for r in quality_classifier.scores(every, model).collect()}
    assert np.mean([got[i] >= 0.7 for i, _ in good if i % 2]) > 0.9 and np.mean([got[i] < 0.7 for i, _ in bad if i % 2]) > 0.9
    model = toxicity.fit(every, labels, learn)
    got = {r.doc_id: r.score for r in quality_classifier.scores(every, model).collect()}
    assert np.mean([got[i] >= 0.7 for i, _ in toxic if i % 2]) > 0.9 and np.mean([got[i] < 0.7 for i, _ in good if i % 2]) > 0.95
    assert model.lexicon.match("dreadfulx") > 0 and model.lexicon.match("dreedfulo") > 0 and not model.lexicon.match("garden")
    for fit in (quality_classifier.fit, toxicity.fit):
        empty = fit(docs, labels.where("false"), learn)
        assert {r.score for r in quality_classifier.scores(docs, empty).collect()} == {0.5}
        assert quality_classifier.scores(none, empty).count() == 0


def test_toxicity_of_misspelled_terms():
    """Digits and marks in a word, and terms of five letters; a near word of clean documents is spared alone."""
    rng = np.random.default_rng(2)
    base = ["river", "stone", "light", "the", "of", "garden", "poser"]
    clean = [" ".join(rng.choice(base, 30)) + f" n{i}" for i in range(120)]
    terms = ["idiot", "moron", "loser", "pathetic", "stupid"]
    bad = [" ".join(rng.choice(base, 30)) + f" {terms[i % 5]} n{i}" for i in range(120)]
    model = toxicity.Model.fit(clean + bad, np.array([0.0] * 120 + [1.0] * 120))
    for w in ("path3tic", "idi0t", "mor0n", "st*pid", "(st*pid!)", "lozer"):
        assert model.matches(f"the river of {w} stone"), w
    assert not model.matches("the river of poser stone garden light")


def test_language_id(spark):
    docs = table(spark, [(i, "the river and the stone of it") for i in range(5)]).union(table(spark, [(9, "le fleuve et la pierre de lui")]).withColumn("lang", F.lit("fr")))
    rows = [(1, "http://a.b.org/en/1", "<html lang='en'><body>the stone of the river</body></html>"), (2, "http://a.b.org/en/2", "<html lang=\"en\"><p>le fleuve et la pierre de lui le la et</p></html>"), (3, None, None), (4, "odd", ""), (4, "odd", "")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = sorted((r.page_id, r.lang) for r in language_id.identify(pages, docs).collect())
    assert got[0] == (1, "en") and got[1] == (2, "fr") and len(got) == 5
    assert language_id.identify(pages.where("false"), docs).count() == 0


def test_language_id_of_small_languages(spark):
    """Next to a hot language of 6,000 words, 20 languages of one document each keep all their words."""
    rows = [(i, " ".join(f"a{chr(97 + j % 26)}{chr(97 + j // 26 % 26)}{chr(97 + j // 676)}" for j in range(6000)), "en") for i in range(3)]
    own = {f"{c}x": [f"{c}{d}zz" for d in "bcdfghjkl"] for c in "bcdefghijklmnopqrstu"}
    rows += [(100 + i, " ".join(w), lang) for i, (lang, w) in enumerate(own.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(i, f"http://h{i}.org/en/1", f"<html lang='en'><p>{' '.join(w)}</p></html>") for i, w in enumerate(own.values())], "page_id long, url string, html string")
    got = {r.page_id: r.lang for r in language_id.identify(pages, docs).collect()}
    assert got == dict(enumerate(own))


def test_near_duplicates_keep_one_row_of_each_component(spark):
    near = PROSE + " one more"
    other = " ".join(f"q{i}" for i in range(50))
    alone = " ".join(f"z{i}" for i in range(50))
    rows = [(1, PROSE), (1, PROSE), (3, near), (7, alone), (7, near), (None, PROSE), (None, other), (None, other), (None, None), (8, "")]
    got = corpus_pipeline.near_duplicates_stage(spark, table(spark, rows), None)
    assert got.columns == table(spark, rows).columns
    want = [(1, PROSE), (7, alone), (None, other), (None, None), (8, "")]
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == sorted((str(i), str(t)) for i, t in want)


def test_pipeline_stages(spark, docs, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and sum(r.doc_id == 2 for r in rows) == 0 and any(r.doc_id == 1 for r in rows)
    assert zlib.crc32(b"") == 0 and hashlib.sha256(b"")
