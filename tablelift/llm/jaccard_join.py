"""N-gram Jaccard join by a token-group matrix.

A document is the set of its distinct k-word shingles; equal sets are one class. The shingles are dealt
by hash to parts, as many that two sets above the threshold must agree on a whole part: if J >= t they
differ in at most (1 - t) / (1 + t) * (|A| + |B|) shingles, so more parts than that leave some untouched. A
part's hash is a token of the class; sets of which many parts are empty have the hashes of a prefix as well. The number of parts depends on a size band; a class has the tokens of its
own band, and of the next one if a larger partner can be there. Classes meet by their tokens in PASSES ranges of
tokens one after the other.

Each class that shares tokens is first compared with one hub, the least class of most of its tokens. What
hangs together then needs no further comparison, so that only tokens found in two components or more go on:
a large group of near copies is one component and not a square of pairs. Their classes are
partitioned into groups (of one size band and of one component where it is large, of the same least neighbour elsewhere, split to
about GROUP). The token-group matrix has a row for each token and group; two groups are a candidate if they
share a token; tokens all of whose groups another token has too are left out. A class's signature is a bitmap of its shingles: a bit that only one set has stands for a
shingle that the other lacks, which bounds the overlap from above. Only the classes of a pair of groups that
can reach the threshold by it are opened, and compared by one product of incidence matrices.

Cases: null and empty texts have an empty set and link with nothing; fewer than k words are one
shingle; repeated rows and equal sets share a class, rows with the same doc_id are judged each; rows
without a doc_id get the component of their class; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import batch, drop_written, text_bytes, trimmed, written
from tablelift.llm.shingles import groups, mix, sequences, word_hashes

#: Ratio of the sizes in a band (more for thresholds under 0.8), and classes of a group.
BAND, GROUP = 1.25, 64
#: One part more for so many shingles that may differ.
SPARE = 10
#: Bits of a token beyond those of the number of documents, and ranges of tokens that are met one after the other.
TOKEN_BITS, PASSES = 26, 12
#: Names of classes that are tried, as they must differ.
TRIES = 8
#: Rows of a batch where a row holds sets or groups of signatures.
LARGE_ROWS = 32
#: Least bits of a signature; larger sets have a power of two above their size.
BITS = 1024
#: Each range of tokens has a column, so that it is read alone.
RANGES = [f"tokens{i}" for i in range(PASSES)]
_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("sig", pa.binary()), *((c, pa.list_(pa.int64())) for c in RANGES)])
SETS = "doc_id long, n long, h1 long, h2 long, sig binary, " + ", ".join(f"{c} array<bigint>" for c in RANGES)


def _sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(texts, lower=True)
    every = sequences(words, k)
    at = 0
    for n in counts.tolist():
        if n >= k:
            yield np.unique(every[at : at + n - k + 1])
        else:
            yield sequences(words[at : at + n], n, salt=n) if n else every[:0]
        at += n


def _tokens(shingles: np.ndarray, num: int, den: int) -> np.ndarray:
    """Part hashes of a set, for threshold num / den; empty parts have none.

    With `differ` shingles of two sets unequal, all but `differ` parts are equal. If either set has so few empty parts
    that more parts are equal than it has empty ones, an equal part has a token. A set with too many empty parts has
    its prefix as well: of any order of shingles, two sets above the threshold share one of the first
    n - ceil(t * n) + 1. Where the parts of both sets say nothing, both have their prefix, so that no link is missed.
    """
    n, hashes, ratio, sparse = len(shingles), [], max(BAND, den / num), False
    band = int(math.log(n, ratio) + 1e-9) if n else 0
    for b in (band, band + 1):
        if not n or (b > band and n * den < num * ratio**b * (1 - 1e-9)):
            continue
        differ = int((den - num) * 2 * ratio ** (b + 1) * (1 + 1e-9) / (den + num))
        parts = differ + 1 + -(-differ // SPARE)
        part = (mix(shingles + np.uint64(b + 1)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) != 0]))
        sums = np.add.reduceat(mix(shingles[order] ^ np.uint64(0xABCDEF)), starts)
        hashes.append(mix(sums + part[order][starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(b * 1_000_003)))
        sparse |= len(starts) <= differ
    if sparse:
        hashes.append(mix(shingles[: n - -(-num * n // den) + 1] ^ np.uint64(0x517CC1B727220A95)))
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)


def _ranges(tokens: np.ndarray) -> list[np.ndarray]:
    """The tokens of each range, every one in one of them."""
    at = (tokens >> np.uint64(7)) % np.uint64(PASSES)
    return [tokens[at == i].view(np.int64) for i in range(PASSES)]


def _signature(shingles: np.ndarray) -> bytes:
    bits = BITS
    while bits < len(shingles):
        bits *= 2
    found = np.zeros(bits, np.uint8)
    found[(mix(shingles + np.uint64(77)) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(found, bitorder="little").tobytes()


def _folded(sigs: list[bytes], size: int) -> np.ndarray:
    """Signatures as rows of `size` bytes: a longer one's bits are the same hashes modulo less."""
    return np.stack([np.bitwise_or.reduce(np.frombuffer(x, np.uint8).reshape(-1, size), axis=0) for x in sigs]).view(np.uint64)


def _can_link(n_a: np.ndarray, a: list[bytes], n_b: np.ndarray, b: list[bytes], num: int, den: int) -> np.ndarray:
    """Matrix: whether sets with these sizes and signatures can reach num / den."""
    size = min(map(len, [*a, *b]))
    x, y = _folded(a, size), _folded(b, size)
    out = np.zeros((len(a), len(b)), bool)
    for i in range(len(a)):
        only_a = np.bitwise_count(x[i] & ~y).sum(axis=1, dtype=np.int64)
        only_b = np.bitwise_count(y & ~x[i]).sum(axis=1, dtype=np.int64)
        most = np.minimum(n_a[i] - only_a, n_b - only_b)
        out[i] = den * most >= num * (n_a[i] + n_b - most)
    return out


def _scan(k: int, num: int, den: int, bits: int):
    shift = np.uint64(64 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in batches:
            texts, docs = text_bytes(b["text"]), b["doc_id"].to_pylist()
            for lo, hi in groups(texts):
                rows = []
                if len(seen) > 200_000:
                    seen.clear()
                for doc, s in zip(docs[lo:hi], _sets(texts[lo:hi], k), strict=True):
                    h1, h2 = (int(np.bitwise_xor.reduce(mix(s + np.uint64(c)), initial=0).astype(np.int64)) for c in (1, 2))
                    # a row without a doc_id cannot stand for its class; a class's tokens are sent once by a task
                    again = doc is None or (len(s), h1, h2) in seen
                    if doc is not None:
                        seen.add((len(s), h1, h2))
                    rows.append((doc, len(s), h1, h2, *([None] * (1 + PASSES) if again else (_signature(s), *_ranges(_tokens(s, num, den) >> shift)))))
                if rows:
                    yield batch(_SETS, *zip(*rows, strict=True))

    return run


_MEMBERS = pa.schema([("cls", pa.int64()), ("shingles", pa.binary())])


def _again(k: int):
    """The shingles of a class's text, if it is the text of that class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, found = text_bytes(b["text"]), []
            for lo, hi in groups(texts):
                part = b.slice(lo, hi - lo).drop_columns(["text"]).to_pylist()
                for r, s in zip(part, _sets(texts[lo:hi], k), strict=True):
                    if len(s) == r["n"] and int(np.bitwise_xor.reduce(mix(s + np.uint64(1)), initial=0).astype(np.int64)) == r["h1"]:
                        found.append((r["cls"], s.tobytes()))
            if found:
                yield batch(_MEMBERS, *zip(*found, strict=True))

    return run


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
EDGES = "a long, b long"
_MET = pa.schema([("grp", pa.int64()), ("other", pa.int64()), ("cls", pa.int64()), ("comp", pa.int64()), ("side", pa.int32())])
MET = "grp long, other long, cls long, comp long, side int"


def _near_hub(num: int, den: int):
    """Rows a, b whose signatures let them link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            found = [(r["a"], r["b"]) for r in rows if _can_link(np.array([r["n_a"]]), [r["sig_a"]], np.array([r["n_b"]]), [r["sig_b"]], num, den)[0, 0]]
            if found:
                yield batch(_EDGES, *zip(*found, strict=True))

    return run


def _linked(num: int, den: int):
    """Rows a, b whose sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                x, y = np.frombuffer(r["set_a"], np.uint64), np.frombuffer(r["set_b"], np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if den * common >= num * (len(x) + len(y) - common):
                    found.append((r["a"], r["b"]))
            if found:
                yield batch(_EDGES, *zip(*found, strict=True))

    return run


def _meet(num: int, den: int):
    """The classes of two groups (or of one) that can link with one of another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                left, same = r["left"], r["right"] is None
                right = left if same else r["right"]
                (n_a, c_a, s_a), (n_b, c_b, s_b) = (([m["n"] for m in g], [m["comp"] for m in g], [m["sig"] for m in g]) for g in (left, right))
                can = _can_link(np.array(n_a), s_a, np.array(n_b), s_b, num, den) & (np.array(c_a)[:, None] != np.array(c_b)[None])
                rows = [(r["grp"], r["other"], left[j]["cls"], left[j]["comp"], 0) for j in np.flatnonzero(can.any(axis=1)).tolist()]
                rows += [] if same else [(r["grp"], r["other"], right[j]["cls"], right[j]["comp"], 1) for j in np.flatnonzero(can.any(axis=0)).tolist()]
                if rows:
                    yield batch(_MET, *zip(*rows, strict=True))

    return run


def _open(num: int, den: int):
    def links(left: list[dict], right: list[dict], same: bool) -> list[tuple[int, int]]:
        a, b = ([np.frombuffer(m["shingles"], np.uint64) for m in g] for g in (left, right))
        if not same:
            # bound: no class of a group shares more with a class of the other than with its union
            union, other = np.unique(np.concatenate(b)), np.unique(np.concatenate(a))
            keep_a = [i for i, s in enumerate(a) if den * np.isin(s, union, assume_unique=True).sum() >= num * len(s)]
            keep_b = [i for i, s in enumerate(b) if den * np.isin(s, other, assume_unique=True).sum() >= num * len(s)]
            left, a = [left[i] for i in keep_a], [a[i] for i in keep_a]
            right, b = [right[i] for i in keep_b], [b[i] for i in keep_b]
        if not a or not b:
            return []
        members, every = (left, a) if same else ([*left, *right], [*a, *b])
        names, codes = np.unique(np.concatenate(every), return_inverse=True)
        sizes = [len(s) for s in every]
        rows = np.repeat(np.arange(len(sizes)), sizes)
        common = np.zeros((len(sizes), len(sizes)))
        for lo in range(0, len(names), 8192):  # bounded slices of the shingles
            inside = (codes >= lo) & (codes < lo + 8192)
            matrix = np.zeros((len(sizes), min(8192, len(names) - lo)), np.float32)
            matrix[rows[inside], codes[inside] - lo] = 1
            common += matrix @ matrix.T
        size = np.array(sizes, float)
        near = np.triu(den * common >= num * (size[:, None] + size[None] - common), 1)
        root = list(range(len(sizes)))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        first: dict = {}  # what hangs together before
        for i, m in enumerate(members):
            root[i] = first.setdefault(m["comp"], i)
        out, border = [], len(a)
        pairs = list(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))
        # links inside a group are told when the group is opened on itself; here they only say what
        # hangs together, so that two groups which do need one link
        for inner in (True, False):
            for i, j in pairs:
                if (same or (i < border) == (j < border)) == inner and top(i) != top(j):
                    root[top(j)] = top(i)
                    if same or not inner:
                        out.append((members[i]["cls"], members[j]["cls"]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                left, right = ([m for m in r["items"] if m["side"] == side] for side in (0, 1))
                found = links(left, right or left, not right)
                if found:
                    yield batch(_EDGES, *zip(*found, strict=True))

    return run


def components(edges: DataFrame) -> DataFrame:
    """node and label, the least node it is linked with, by label passing with shortcuts."""
    both = written(edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b").distinct(), "edges")
    labels = held = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.least("label", "near").alias("next"), F.col("label").alias("old"))
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        new = written(step.join(jump, "next", "left").select("node", F.least("next", "far").alias("label"), (F.least("next", "far") != F.col("old")).alias("moved")), "labels")
        drop_written(held)
        if not new.where("moved").head(1):
            drop_written(both)
            return new.select("node", "label")
        labels, held = new.select("node", "label"), new


def _near(tokened: DataFrame) -> list[DataFrame]:
    """cls, token, least (of the token's classes) for tokens of two classes or more; PASSES ranges of hashes
    one after the other, so that the shuffles of one are gone when the next begins. A table for each range."""
    out = []
    for i, c in enumerate(RANGES):
        tokens = tokened.select("cls", F.explode(c).alias("token"))
        shared = tokens.groupBy("token").agg(F.min("cls").alias("least"), F.max("cls").alias("most")).where("least < most").select("token", "least")
        out.append(written(tokens.join(shared, "token").distinct(), f"near{i}"))
    return out


def _widest(matrix: DataFrame) -> DataFrame:
    """The matrix (token, grp, pure, wide: the token's number of groups) without tokens all of whose groups another
    token has too: they say nothing more of which groups meet. A token is held against one other, the widest one
    of its least or of its largest group, so that this takes as many rows as the matrix has. The table given goes."""
    for end in (F.min, F.max):
        top = matrix.groupBy("grp").agg(F.max_by("token", F.struct("wide", "token")).alias("top"))
        own = matrix.groupBy("token").agg(end("grp").alias("grp"), F.first("wide").alias("wide")).join(top, "grp").where("token <> top").select("token", "top", "wide")
        held = matrix.select("token", "grp").join(own, "token").join(matrix.select(F.col("token").alias("top"), "grp"), ["top", "grp"])
        idle = held.groupBy("token").agg((F.count("*") == F.first("wide")).alias("idle")).where("idle").select("token")
        kept = written(matrix.join(idle, "token", "left_anti"), "matrix-wide")
        drop_written(matrix)
        matrix = kept
    return matrix


def join(docs: DataFrame, k: int = 3, num: int = 9, den: int = 10) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id that links reach), a row for each row of docs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # tokens have as many bits as keeps chance meetings few, whatever the number of documents
    bits = min(64, TOKEN_BITS + rows.count().bit_length())
    scanned = written(rows.mapInArrow(trimmed(_scan(k, num, den, bits)), SETS), "scanned")
    grouped = scanned.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("sig", ignorenulls=True).alias("sig"))
    for salt in range(TRIES):
        name = F.xxhash64("n", "h1", "h2", F.lit(salt))
        classes = written(grouped.withColumn("cls", name), "classes")
        if not classes.groupBy("cls").count().where("count > 1").head(1):
            break
        drop_written(classes)
    else:
        raise RuntimeError(f"names of classes collided in each of {TRIES} attempts")
    sets = written(scanned.select("doc_id", "n", "h1", "h2"), "sets")
    met_by = _near(scanned.where("sig is not null").select(name.alias("cls"), *RANGES))
    near = reduce(DataFrame.unionByName, met_by)
    drop_written(scanned)

    def shingles(wanted: DataFrame, name: str) -> DataFrame:
        """cls and shingles of the wanted classes, from their texts."""
        chosen = classes.join(wanted.select("cls").distinct(), "cls").select("cls", "rep", "n", "h1")
        texts = rows.join(chosen, rows["doc_id"] == chosen["rep"]).select("rep", "cls", "n", "h1", "text")
        # rows with one doc_id and one text are one; they are in one partition already
        one = texts.withColumn("hash", F.xxhash64("text")).groupBy("rep", "cls", "n", "h1", "hash").agg(F.first("text").alias("text"))
        return written(one.select("cls", "n", "h1", "text").mapInArrow(trimmed(_again(k)), "cls long, shingles binary"), name)

    # each class and its hub
    hubs = near.where("cls <> least").groupBy("cls", "least").count().groupBy("cls").agg(F.max_by("least", F.struct("count", -F.col("least"))).alias("hub"))
    ends = hubs.select(F.col("cls").alias("a"), F.col("hub").alias("b"))
    for end in "ab":
        ends = ends.join(classes.select(F.col("cls").alias(end), F.col("n").alias(f"n_{end}"), F.col("sig").alias(f"sig_{end}")), end)
    stars = written(ends.mapInArrow(trimmed(_near_hub(num, den)), EDGES), "stars")
    texts = shingles(stars.select(F.explode(F.array("a", "b")).alias("cls")), "star-sets")
    ends = stars
    for end in "ab":
        stars = stars.join(texts.select(F.col("cls").alias(end), F.col("shingles").alias(f"set_{end}")), end)
    stars = written(stars.mapInArrow(trimmed(_linked(num, den)), EDGES), "star-links", LARGE_ROWS)
    drop_written(texts, ends)
    comps = components(stars).select(F.col("node").alias("cls"), F.col("label").alias("comp"))

    # what is left: tokens of two components or more
    split = near.join(comps, "cls", "left").select("cls", "token", F.coalesce("comp", "cls").alias("comp"))
    several = split.groupBy("token").agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least < most").select("token", "least")
    left = written(split.join(several, "token"), "left")
    drop_written(*met_by)
    label = left.groupBy("cls", "comp").agg(F.min("least").alias("least"))
    large = label.groupBy("comp").agg((F.count("*") >= GROUP // 2).alias("large"))
    # a token is found in two size bands, so groups of one band keep its row of the matrix short
    band = F.floor(F.log("n") / math.log(max(BAND, den / num)))
    name = F.when(F.col("large"), F.xxhash64("comp", band, F.lit(1))).otherwise(F.xxhash64("least", band))
    label = label.join(large, "comp").join(classes.select("cls", "n"), "cls").select("cls", "comp", name.alias("label"))
    counts = label.groupBy("label").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    members = written(label.join(counts, "label").select("cls", "comp", F.xxhash64("label", F.pmod(F.xxhash64("cls"), F.col("parts"))).alias("grp")), "members")
    pure = F.when(F.min("comp") == F.max("comp"), F.min("comp"))
    signed = classes.select("cls", "n", "sig").join(members, "cls")
    packed = written(signed.groupBy("grp").agg(pure.alias("pure"), F.collect_list(F.struct("cls", "comp", "n", "sig")).alias("items")), "groups")
    matrix = written(left.select("token", "cls").join(members, "cls").select("token", "grp").distinct().join(packed.select("grp", "pure"), "grp"), "matrix")
    # tokens with the same groups say the same: one of them is enough, and none with one group
    hashes = [F.sum(F.xxhash64("grp", F.lit(i)).cast("decimal(38,0)")).alias(f"x{i}") for i in (1, 2)]
    spread = matrix.groupBy("token").agg(F.count("*").alias("wide"), *hashes).where("wide > 1")
    single = spread.groupBy("wide", "x1", "x2").agg(F.min("token").alias("token"))
    once = written(matrix.join(single.select("token", "wide"), "token"), "matrix-once")
    drop_written(matrix, left, members)
    wide = _widest(once)
    matrix = wide.drop("wide")
    apart = (F.col("grp") < F.col("other")) & ~F.coalesce(F.col("pure") == F.col("kind"), F.lit(False))
    pairs = matrix.join(matrix.select("token", F.col("grp").alias("other"), F.col("pure").alias("kind")), "token").where(apart).select("grp", "other").distinct()
    own = packed.where("pure is null").select("grp", F.col("grp").alias("other"), F.col("items").alias("left"), F.lit(None).cast(packed.schema["items"].dataType).alias("right"))
    cross = pairs.join(packed.select("grp", F.col("items").alias("left")), "grp").join(packed.select(F.col("grp").alias("other"), F.col("items").alias("right")), "other").select("grp", "other", "left", "right")
    met = written(own.unionByName(cross).mapInArrow(trimmed(_meet(num, den)), MET), "met", LARGE_ROWS)
    drop_written(packed, wide)
    texts = shingles(met, "met-sets")
    opened = met.join(texts, "cls").groupBy("grp", "other").agg(F.collect_list(F.struct("side", "cls", "comp", "shingles")).alias("items")).select("items")
    links = written(opened.mapInArrow(trimmed(_open(num, den)), EDGES), "links", LARGE_ROWS)
    drop_written(met, texts)
    linked = components(links.unionByName(stars))
    drop_written(links, stars)
    home = classes.join(linked, classes["cls"] == linked["node"], "left").select("n", "h1", "h2", "rep", F.coalesce("label", "cls").alias("label"))
    least = home.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = home.join(least, "label").select(F.col("n").alias("cn"), F.col("h1").alias("c1"), F.col("h2").alias("c2"), "component_id")
    out = sets.join(named, (F.col("n") == F.col("cn")) & (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
