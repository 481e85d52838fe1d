"""Repeated passages by de Bruijn compaction.

Windows of `window` words are the edges of a de Bruijn graph over k-mers of words. The edges of a text that
share their least k-mer follow one another without a branch: the scan makes one path row of them (k-mer,
document, place of the first edge, five hash bytes for each edge). Path rows meet by k-mer, in PASSES
ranges of k-mers one after the other. A path that a smaller document has too is repeated whole;
only paths that share a k-mer but differ, a branch, are opened to their edges, which meet one by one.
Every repeated path knows its source: a smaller document and the place there.

Repeated paths that follow one another in a document and in their source make one long span: their starts are joined
with their ends, where no path is open before is a head, where none is open after a tail, and the i-th head of a
document and source joins the i-th tail. The spans are verified at their source coordinates:
the texts are read again, and a 128-bit digest of the words of the span must be equal at both ends.
If one differs, hashes have collided, and all is done again with other hashes.

What a scan slice can tell is settled there, so that a passage which all documents share sends a row for
each slice and not for each document: equal paths of the slice, and branches of k-mers which the slice has in two
documents. A marker row tells other slices that a k-mer is open.

A word is removed if a window that covers it starts in a document with a smaller doc_id too.

Cases: null and empty texts have no words; rows without a doc_id come after all others; rows with the
same doc_id do not remove from one another; very long texts are read whole; an empty table gives an
empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablelift.llm.common import batch, drop_written, numbered, text_bytes, trimmed, written
from tablelift.llm.shingles import groups, mix, sequences, word_hashes

KMER, EDGE_BYTES = 7, 5
#: Ranges of k-mers that meet one after the other: half of the path rows are on disk at a time.
PASSES = 2
#: Times that all is done again after a collision.
TRIES = 8
#: In place of a missing doc_id: larger than all others.
LAST = (1 << 63) - 1
PATH, SETTLED, OPEN = 0, 1, 2

_PATHS = pa.schema([("kind", pa.int8()), ("kmer", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("edges", pa.binary()), ("x", pa.int64()), ("x_tag", pa.int64()), ("x_at", pa.int32())])
PATHS = "kind byte, kmer long, doc long, tag long, at int, n int, edges binary, x long, x_tag long, x_at int"


def _least(*keys: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by the keys, then document and place; in that order the starts of equal keys, and for each
    row the first of its keys."""
    order = np.lexsort((at, doc, *reversed(keys)))
    change = np.zeros(len(order), bool)
    change[:1] = True
    for k in keys:
        change[1:] |= k[order][1:] != k[order][:-1]
    starts = np.flatnonzero(change)
    return order, starts, order[starts][np.cumsum(change) - 1]


def _paths(window: int, salt: int, part: int):
    k, reach = KMER, window - KMER

    def of(docs: np.ndarray, tags: np.ndarray, words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        n = len(words) - window + 1
        if n <= 0:
            return batch(_PATHS, *[[]] * 10)
        first = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        kmers = sequences(words, k, salt=salt)
        least, place = kmers[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, reach + 1):
            other = kmers[j : j + n]
            less = other < least
            least[less] = other[less]
            place[less] = j
        place += np.arange(n)
        valid = owner[:n] == owner[window - 1 :]
        edge = sequences(words, window, salt=99 + salt)
        starts = valid & np.concatenate([[True], (place[1:] != place[:-1]) | ~valid[:-1]])
        starts = np.flatnonzero(starts)
        stops = np.concatenate([starts[1:], [n]])
        lost = np.concatenate([[0], np.cumsum(~valid)])
        length = stops - starts - (lost[stops] - lost[starts])
        if not len(starts):
            return batch(_PATHS, *[[]] * 10)
        kmer, who = least[starts], owner[starts]
        doc, tag, at = docs[who], tags[who], (starts - first[who]).astype(np.int32)
        # a path is of less than `window` edges, so that its first and last edge and its length have all its words
        path = mix(edge[starts] + np.uint64(3) * mix(edge[starts + length - 1])) + length.astype(np.uint64)
        order, _, chief = _least(kmer, path, doc=doc, at=at)
        source = np.empty(len(order), np.int64)
        source[order] = chief
        settled = doc > doc[source]
        # k-mers with two paths and two documents are open
        k_starts = np.flatnonzero(np.concatenate([[True], kmer[order][1:] != kmer[order][:-1]]))
        sizes = np.diff(np.concatenate([k_starts, [len(order)]]))
        low, high = np.minimum.reduceat(doc[order], k_starts), np.maximum.reduceat(doc[order], k_starts)
        other = np.minimum.reduceat(path[order], k_starts) != np.maximum.reduceat(path[order], k_starts)
        branch = other & (low != high)
        opened = np.empty(len(order), bool)
        opened[order] = np.repeat(branch, sizes)
        opened &= ~settled

        kinds, columns = [], []

        def add(kind, kmer, doc, tag, at, n, edges, x=None, x_tag=None, x_at=None):
            if len(doc):
                empty = np.zeros(len(doc), np.int64)
                kinds.append(np.full(len(doc), kind, np.int8))
                columns.append((kmer.view(np.int64), doc, tag, at, n, edges, *(empty if c is None else c for c in (x, x_tag, x_at))))

        def anywhere(doc, at):  # a k-mer of its own for rows that meet no other
            return mix(doc.view(np.uint64) * np.uint64(0x5851F42D4C957F2D) + at.astype(np.uint64))

        raw = np.ascontiguousarray(edge.view(np.uint8).reshape(-1, 8)[:, :EDGE_BYTES]).tobytes()
        mine = (kmer >> np.uint64(20)) % np.uint64(PASSES) == part
        plain = ~settled & ~opened & mine
        add(PATH, kmer[plain], doc[plain], tag[plain], at[plain], length[plain], [raw[s * EDGE_BYTES : (s + m) * EDGE_BYTES] for s, m in zip(starts[plain].tolist(), length[plain].tolist(), strict=True)])
        if part == 0:
            # settled paths that follow one another, in their sources too, are one
            done = np.flatnonzero(settled)
            s = source[done]
            on = np.zeros(len(done), bool)
            on[1:] = (done[1:] == done[:-1] + 1) & (who[done][1:] == who[done][:-1]) & (who[s][1:] == who[s][:-1]) & (at[s][1:] - at[done][1:] == at[s][:-1] - at[done][:-1]) & (at[done][1:] == at[done][:-1] + length[done][:-1])
            first_of = np.flatnonzero(~on)
            sums = np.add.reduceat(length[done], first_of) if len(done) else length[:0]
            done, s = done[first_of], s[first_of]
            add(SETTLED, anywhere(doc[done], at[done]), doc[done], tag[done], at[done], sums, [None] * len(s), doc[s], tag[s], at[s])
        opened &= mine
        branch &= mine[order[k_starts]]
        if branch.any():
            heads = order[k_starts][branch]
            for end in (low, high):
                add(PATH, kmer[heads], end[branch], tag[heads], at[heads], np.zeros(len(heads), np.int64), [b""] * len(heads))
            row = np.repeat(np.flatnonzero(opened), length[opened])
            step = np.arange(len(row)) - np.repeat(np.cumsum(length[opened]) - length[opened], length[opened])
            e, e_at = edge[starts[row] + step] & np.uint64((1 << 8 * EDGE_BYTES) - 1), (at[row] + step).astype(np.int32)
            e_order, _, e_chief = _least(kmer[row], e, doc=doc[row], at=e_at)
            e_source = np.empty(len(row), np.int64)
            e_source[e_order] = e_chief
            done = doc[row] > doc[row][e_source]
            s = e_source[done]
            add(SETTLED, anywhere(doc[row][done], e_at[done]), doc[row][done], tag[row][done], e_at[done], np.ones(len(s), np.int64), [None] * len(s), doc[row][s], tag[row][s], e_at[s])
            r, p = row[~done], (starts[row] + step)[~done].tolist()
            add(OPEN, anywhere(doc[r], e_at[~done]), doc[r], tag[r], e_at[~done], np.ones(len(r), np.int64), [raw[i * EDGE_BYTES : (i + 1) * EDGE_BYTES] for i in p], kmer[r].view(np.int64))
        if not columns:
            return batch(_PATHS, *[[]] * 10)
        merged = [sum(c, []) if isinstance(c[0], list) else np.concatenate(c) for c in zip(*columns, strict=True)]
        return batch(_PATHS, np.concatenate(kinds), *[c if isinstance(c, list) else c.astype(f.type.to_pandas_dtype()) for c, f in zip(merged, list(_PATHS)[1:], strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, docs = text_bytes(b["text"]), np.asarray(b["doc"], np.int64)
            tags = np.asarray(b["tag"], np.int64)
            for lo, hi in groups(texts, 1 << 22):
                yield of(docs[lo:hi], tags[lo:hi], *word_hashes(texts[lo:hi]))

    return run


def _met(rows: DataFrame, window: int, salt: int, part: int) -> DataFrame:
    """Paths that are repeated whole (kind SETTLED: x, x_tag, x_at are the source), and opened edges (OPEN: x is the k-mer)."""
    paths = rows.mapInArrow(trimmed(_paths(window, salt, part)), PATHS).repartition("kmer")
    equal, shared = Window.partitionBy("kmer", "edges"), Window.partitionBy("kmer")
    seen = paths.withColumn("first", F.min(F.struct("doc", "tag", "at")).over(equal))
    seen = seen.withColumn("branch", (F.min("edges").over(shared) != F.max("edges").over(shared)) & (F.min("doc").over(shared) != F.max("doc").over(shared)))

    def row(kind, at, n, edge, x, x_tag, x_at):
        return F.struct(F.lit(kind).cast("byte").alias("kind"), at.alias("at"), n.alias("n"), edge.alias("edge"), x.alias("x"), x_tag.alias("x_tag"), x_at.alias("x_at"))

    none = F.lit(None).cast("binary")
    known = F.array(row(SETTLED, F.col("at"), F.col("n"), none, F.col("x"), F.col("x_tag"), F.col("x_at")))
    first = F.array(row(SETTLED, F.col("at"), F.col("n"), none, F.col("first.doc"), F.col("first.tag"), F.col("first.at")))
    own = F.array(row(OPEN, F.col("at"), F.col("n"), F.col("edges"), F.col("x"), F.lit(0).cast("long"), F.lit(0)))
    edges = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: row(OPEN, F.col("at") + i, F.lit(1), F.substring(F.col("edges"), i * EDGE_BYTES + 1, F.lit(EDGE_BYTES)), F.col("kmer"), F.lit(0).cast("long"), F.lit(0)))
    is_path = (F.col("kind") == PATH) & (F.col("n") > 0)
    result = F.when(F.col("kind") == SETTLED, known).when(F.col("kind") == OPEN, own).when(is_path & (F.col("first.doc") < F.col("doc")), first).when(is_path & F.col("branch"), edges)
    return seen.select("doc", "tag", F.explode(result).alias("r")).select("doc", "tag", "r.*")


def _pieces(found: DataFrame) -> DataFrame:
    """Repeated paths and edges with their source: doc, tag, at, n, x, x_tag, x_at."""
    # an edge that many documents have is aggregated before it is shuffled, and a join may split it
    opened = found.where(F.col("kind") == OPEN)
    first = opened.groupBy("x", "edge").agg(F.min(F.struct("doc", "tag", "at")).alias("first"), F.max("doc").alias("last")).where(F.col("first.doc") < F.col("last"))
    single = opened.join(first, ["x", "edge"]).where(F.col("first.doc") < F.col("doc"))
    names = ["doc", "tag", "at", "n", "x", "x_tag", "x_at"]
    edges = single.select("doc", "tag", "at", "n", F.col("first.doc").alias("x"), F.col("first.tag").alias("x_tag"), F.col("first.at").alias("x_at"))
    return found.where(F.col("kind") == SETTLED).select(*names).unionByName(edges.select(*names))


def _spans(pieces: DataFrame) -> DataFrame:
    """Paths that follow one another in a document and in their source, compacted by joins: doc, tag, at, n, x, x_tag, x_at."""
    key = ["doc", "tag", "x", "x_tag", "shift"]
    pieces = pieces.withColumn("shift", F.col("x_at") - F.col("at"))
    starts = pieces.groupBy(*key, "at").agg(F.count("*").alias("starts"))
    ends = pieces.groupBy(*key, (F.col("at") + F.col("n")).alias("at")).agg(F.count("*").alias("ends"))
    # where as many paths end as start, a span goes on; repeated rows bring paths that overlap
    net = (F.coalesce("starts", F.lit(0)) - F.coalesce("ends", F.lit(0))).alias("net")
    edges = written(starts.join(ends, [*key, "at"], "full_outer").select(*key, "at", net).where("net <> 0"), "ends")
    open_ = F.sum("net").over(Window.partitionBy(*key).orderBy("at"))  # as many rows as a text has paths
    marked = edges.withColumn("after", open_).where((F.col("after") == 0) | (F.col("after") == F.col("net"))).withColumn("head", F.col("after") > 0)
    ranked = marked.withColumn("rank", F.row_number().over(Window.partitionBy(*key, "head").orderBy("at"))).drop("net", "after")
    joined = ranked.where("head").drop("head").join(ranked.where("not head").drop("head").withColumnRenamed("at", "stop"), [*key, "rank"])
    return joined.select("doc", "tag", "at", (F.col("stop") - F.col("at")).alias("n"), "x", "x_tag", (F.col("at") + F.col("shift")).alias("x_at"))


DIGESTS = "array<struct<doc: long, tag: long, at: int, n: int, digest: binary>>"
_DIGESTS = pa.list_(pa.struct([("doc", pa.int64()), ("tag", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("digest", pa.binary())]))


def _cut(window: int, text_at: int, n_columns: int, layout: bool):
    """Rows with their text cut, their numbers of words, and digests of the words that they were asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, words_all, removed_all, digests = [], [], [], []
            for raw, spans in zip(text_bytes(b.column(text_at)), b["spans"].to_pylist(), strict=True):
                words, removed, said = raw.split(), 0, []
                for s in spans or []:
                    said.append({"doc": s["x"], "tag": s["x_tag"], "at": s["x_at"], "n": s["n"], "digest": hashlib.blake2b(b" ".join(words[s["at"] : s["at"] + s["n"] + window - 1]), digest_size=16).digest()})
                own = [s for s in spans or [] if s["own"]]
                if own:
                    cover = np.zeros(len(words) + window, np.int32)
                    for s in own:
                        cover[s["at"]] += 1
                        cover[s["at"] + s["n"] + window - 1] -= 1
                    kept = np.cumsum(cover)[: len(words)] == 0
                    removed = int(len(words) - kept.sum())
                    text = b" ".join(compress(words, kept.tolist()))
                else:
                    text = raw if layout else b" ".join(words)
                texts.append(text.decode())
                words_all.append(len(words))
                removed_all.append(removed)
                digests.append(said)
            arrays = list(b.columns[:n_columns])
            if layout:  # a null text that loses nothing stays null
                texts = [None if x is None else t for x, t in zip(b.column(text_at).to_pylist(), texts, strict=True)]
            arrays[text_at] = pa.array(texts, pa.string())
            arrays += [pa.array(words_all, pa.int64()), pa.array(removed_all, pa.int64()), pa.array(digests, _DIGESTS)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*[f"c{i}" for i in range(n_columns)], "n_words", "n_removed", "digests"])

    return run


def removed(docs: DataFrame, window: int = 13, layout: bool = False) -> DataFrame:
    """docs under the names c0, c1, ..., the text in place of which the kept words stand, joined by a space;
    n_words and n_removed. With layout, a text that loses nothing stays as it is."""
    rows, at = numbered(docs)
    text_at = docs.columns.index("text")
    rows = rows.withColumn(at["text"], F.col(at["text"]).cast("string"))
    for attempt in range(TRIES):
        bytes_ = F.coalesce(F.col(at["text"]), F.lit("")).cast("binary")
        tag = F.crc32(F.concat(F.lit(f"{attempt} ").cast("binary"), bytes_)).bitwiseXOR(F.shiftleft(F.octet_length(bytes_).cast("long"), 32))
        keyed = rows.withColumn("doc", F.coalesce(F.col(at["doc_id"]).cast("long"), F.lit(LAST))).withColumn("tag", tag)
        read = keyed.select("doc", "tag", F.col(at["text"]).alias("text"))
        found = [written(_met(read, window, 1000 * attempt, part), f"found{part}") for part in range(PASSES)]
        both = found[0]
        for f in found[1:]:
            both = both.unionByName(f)
        pieces = written(_pieces(both), "pieces")
        drop_written(*found)
        spans = written(_spans(pieces), "spans")
        drop_written(pieces)
        own = spans.select("doc", "tag", F.struct(F.lit(True).alias("own"), "at", "n", "x", "x_tag", "x_at").alias("s"))
        # what a source is asked for: as many places as its text has, however many documents ask
        asked = spans.select(F.col("x").alias("doc"), F.col("x_tag").alias("tag"), F.col("x_at").alias("at"), "n").distinct()
        asked = asked.select("doc", "tag", F.struct(F.lit(False).alias("own"), "at", "n", F.col("doc").alias("x"), F.col("tag").alias("x_tag"), F.col("at").alias("x_at")).alias("s"))
        wanted = own.unionByName(asked).groupBy("doc", "tag").agg(F.collect_list("s").alias("spans"))
        joined = keyed.join(wanted, ["doc", "tag"], "left").select(*rows.columns, "spans")
        schema = StructType([*rows.schema.fields, *StructType.fromDDL(f"n_words long, n_removed long, digests {DIGESTS}").fields])
        out = written(joined.mapInArrow(trimmed(_cut(window, text_at, len(rows.columns), layout)), schema), "cut")
        drop_written(spans)
        ends = out.select(F.explode("digests").alias("d")).groupBy("d.doc", "d.tag", "d.at", "d.n").agg(F.min("d.digest").alias("low"), F.max("d.digest").alias("high"))
        if ends.where("low <> high").head(1) == []:
            return out.drop("digests")
        drop_written(out)
    raise RuntimeError(f"hashes of different words collided in each of {TRIES} attempts")


def dedup(docs: DataFrame, window: int = 13, layout: bool = False) -> DataFrame:
    """docs with kept_text, n_words and n_removed (in place of columns with such names) and without text."""
    cut = removed(docs, window, layout)
    names = [c if c != "text" else "kept_text" for c in docs.columns]
    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in ("n_words", "n_removed") and (c != "kept_text" or docs.columns[i] == "text")]
    return cut.select(*kept, "n_words", "n_removed")
