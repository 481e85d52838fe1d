"""Exact top-k by integer inner product over a pivot-distance index.

Vectors become integers floor(256 * x). One more component, sqrt(M - |x|^2) with M the largest squared
length, gives all candidates the same length, so that the largest inner product is the least distance.
Every candidate is keyed by its nearest pivot and its distance to it; sorted by distance, the keys of a
pivot are cut into annuli of about CELL_ROWS rows. By the triangle inequality an annulus [a, b] of pivot p holds
nothing closer to q than max(d(q, p) - b, a - d(q, p)). A query first opens the annulus that it falls in at its
nearest pivot; then the STEP annuli of least bound; then, in the order of their bounds, those within the distance of
the k-th vector found by then, where it stops. Bounds have a slack for rounding; scores are exact integers.

Pivots are vectors of a sample in the order of a hash, half the root of the number of rows and at most PIVOTS; every
candidate is indexed. How much the bounds save depends on the vectors: `counts` of top_k() tells it.

Cases: vectors that are null or hold null or non-finite components take no part; shorter vectors count
as filled with zeros; ties go to the smaller vec_id; rows with the same vec_id are candidates of each other, and
each such query row has its ranks; an empty table has no result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import batch, drop_written, trimmed, written

PIVOTS, CELL_ROWS, BLOCK_ROWS, QUERY_ROWS, STEP = 1024, 512, 2048, 128, 8
#: Most annuli of a pivot.
ANNULI = 64


def _integers(column, width: int) -> np.ndarray:
    """Rows of a list column, filled with zeros to a width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pc.list_value_length(column)).astype(np.int64)
    values = np.asarray(column.flatten(), np.int64)
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(top - np.square(x).sum(axis=1), 0))])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = np.square(x).sum(axis=1)[:, None] + np.square(pivots).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


_KEYED = pa.schema([("uid", pa.int64()), ("vec_id", pa.int64()), ("vector", pa.list_(pa.int64())), ("pivot", pa.int32()), ("distance", pa.float64())])
KEYED = "uid long, vec_id long, vector array<bigint>, pivot int, distance double"
_FOUND = pa.schema([("query", pa.int64()), ("uid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
FOUND = "query long, uid long, vec_id long, score long"


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact: in floating point where no sum can leave its integers, else in integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64) if most < 2**52 else q @ x.T


def _open(k: int, width: int):
    """Rows of a block of candidates and a group of queries: the k best of the block for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                uids, ids, asked = (np.asarray(row[c][0].values, np.int64) for c in ("uids", "ids", "query_uids"))
                x, q = _integers(row["vectors"][0].values, width), _integers(row["queries"][0].values, width)
                scores = _products(q, x)
                out = []
                for j, own in enumerate(asked):
                    other = np.flatnonzero(uids != own)
                    s = scores[j][other]
                    if len(s) > k:
                        least = np.partition(s, len(s) - k)[len(s) - k]
                        other, s = other[s >= least], s[s >= least]
                    order = np.lexsort((uids[other], ids[other], -s))[:k]
                    out.append((np.full(len(order), own), uids[other][order], ids[other][order], s[order]))
                if out:
                    yield batch(_FOUND, *map(np.concatenate, zip(*out, strict=True)))

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """query and best, its k best so far. An array of k rows at most for each block stands in the way."""
    kept = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", "uid"))), 1, k)
    return found.groupBy("query").agg(kept.alias("best"))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_column: str = "vec_id", column: str = "embedding", counts: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every` its k best others.

    `counts`, if given, gets the numbers of annuli (cells), queries and opened annuli."""
    clean = F.col(column).isNotNull() & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    base = vectors.where(clean & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("vec_id"), F.transform(column, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("vector"))
    squared = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = base.agg(F.max(squared).alias("top"), F.max(F.size("vector")).alias("width"), F.count("*").alias("n")).head()
    top, width = facts["top"] or 0.0, facts["width"] or 0
    chosen = base.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(max(1, min(PIVOTS, math.isqrt(facts["n"]) // 2))).collect()
    pivots = np.zeros((max(1, len(chosen)), width), np.int64)
    for i, r in enumerate(chosen):
        pivots[i, : len(r["vector"])] = r["vector"]
    lifted = _lift(pivots, top)

    def key(batches):
        for b in batches:
            d = _distances(_lift(_integers(b["vector"], width), top), lifted)
            near = d.argmin(axis=1)
            yield batch(_KEYED, b["uid"], b["vec_id"], b["vector"], near.astype(np.int32), d[np.arange(len(d)), near])

    numbered = base.withColumn("uid", F.monotonically_increasing_id()).select("uid", "vec_id", "vector")
    keyed = written(numbered.mapInArrow(trimmed(key), KEYED), "keyed")
    # a row of ANNULI numbers for each pivot
    edges = F.percentile_approx("distance", [i / ANNULI for i in range(1, ANNULI)], 1000)
    cuts: dict[int, list[float]] = {}
    for r in keyed.groupBy("pivot").agg(F.count("*").alias("n"), edges.alias("edges")).collect():
        wanted = max(1, min(ANNULI, r["n"] // CELL_ROWS))
        cuts[r["pivot"]] = sorted({r["edges"][i * ANNULI // wanted - 1] for i in range(1, wanted)})
    first_cell = dict(zip(sorted(cuts), np.cumsum([0, *[len(cuts[p]) + 1 for p in sorted(cuts)]]).tolist(), strict=False))

    def place(batches):
        for b in batches:
            distance, cell = np.asarray(b["distance"]), np.empty(b.num_rows, np.int32)
            at = np.asarray(b["pivot"])
            for p in np.unique(at).tolist():
                mine = at == p
                cell[mine] = first_cell[p] + np.searchsorted(cuts[p], distance[mine], side="left")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*b.schema.names, "cell"])

    placed = written(keyed.mapInArrow(trimmed(place), KEYED + ", cell int"), "placed")
    drop_written(keyed)
    # PIVOTS * ANNULI rows at most, on the driver and broadcast
    sizes = placed.groupBy("cell").agg(F.min("pivot").alias("pivot"), F.count("*").alias("n"), F.min("distance").alias("a"), F.max("distance").alias("b"))
    cells = sorted(tuple(r) for r in sizes.collect())
    codes, at = np.array([c[0] for c in cells], np.int32), np.array([c[1] for c in cells], int)
    low, high = np.array([c[3] for c in cells]), np.array([c[4] for c in cells])
    n_blocks = F.broadcast(sizes.select("cell", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks")))
    blocks = placed.join(n_blocks, "cell").withColumn("block", F.pmod(F.xxhash64("uid"), "blocks")).groupBy("cell", "block").agg(F.collect_list(F.struct("uid", "vec_id", "vector")).alias("rows")).select("cell", F.col("rows.uid").alias("uids"), F.col("rows.vec_id").alias("ids"), F.col("rows.vector").alias("vectors"))
    blocks = written(blocks, "blocks")
    queries = placed.where(F.col("vec_id") % every == 0)

    def scored(asked: DataFrame) -> DataFrame:
        """asked: uid, vector, cells. Queries of a cell come in groups of bounded size."""
        rows = asked.select("uid", "vector", F.explode("cells").alias("cell"))
        if counts is not None:
            counts["opened"] = counts.get("opened", 0) + rows.count()
        n = rows.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("parts"))
        groups = rows.join(n, "cell").withColumn("part", F.pmod(F.xxhash64("uid"), "parts")).groupBy("cell", "part").agg(F.collect_list(F.struct("uid", "vector")).alias("q")).select("cell", F.col("q.uid").alias("query_uids"), F.col("q.vector").alias("queries"))
        return groups.join(blocks, "cell").select("uids", "ids", "vectors", "query_uids", "queries").mapInArrow(trimmed(_open(k, width)), FOUND)

    def bounded(skip: int, stop: int | None):
        """The annuli from the skip-th to the stop-th in the order of their bounds, without the own one, that are within the bound."""
        schema = pa.schema([("uid", pa.int64()), ("vector", pa.list_(pa.int64())), ("cells", pa.list_(pa.int32()))])

        def run(batches):
            for b in batches:
                q = _integers(b["vector"], width).astype(float)
                norm = np.square(q).sum(axis=1)
                # the query itself is not lifted: its last component is 0
                d = _distances(np.column_stack([q, np.zeros(len(q))]), lifted)[:, at]
                kth = np.array([np.inf if s is None else np.sqrt(max(norm[i] + top - 2 * s, 0)) for i, s in enumerate(b["least"].to_pylist())])
                bound = np.maximum(np.maximum(d - high, low - d), 0)
                slack = 1e-6 * (1 + np.sqrt(top) + np.sqrt(norm))[:, None]
                open_ = (bound <= kth[:, None] + slack) & (codes[None] != np.asarray(b["own"])[:, None])
                order = np.argsort(bound, axis=1, kind="stable")[:, skip:stop]
                yield batch(schema, b["uid"], b["vector"], [codes[o[open_[i, o]]].tolist() for i, o in enumerate(order)])

        return run

    def known(best: DataFrame) -> DataFrame:
        least = F.when(F.size("best") >= k, -F.element_at("best", k)["minus"])
        return queries.select("uid", "vector", F.col("cell").alias("own")).join(best.select(F.col("query").alias("uid"), least.alias("least")), "uid", "left")

    def rows_of(best: DataFrame) -> DataFrame:
        return best.select("query", F.explode("best").alias("x")).select("query", "x.uid", "x.vec_id", (-F.col("x.minus")).alias("score"))

    best = written(_best(scored(queries.select("uid", "vector", F.array("cell").alias("cells"))), k), "best")
    for skip, stop in ((0, STEP), (STEP, None)):
        found = scored(known(best).mapInArrow(trimmed(bounded(skip, stop)), "uid long, vector array<bigint>, cells array<int>"))
        best = written(_best(found.unionByName(rows_of(best)), k), "best")
    if counts is not None:
        counts |= {"cells": len(cells), "queries": queries.count()}
    ranked = best.join(queries.select(F.col("uid").alias("query"), F.col("vec_id").alias("query_id")), "query")
    return ranked.select("query_id", F.posexplode("best").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.minus")).alias("score"))
