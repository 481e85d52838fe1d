"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become pieces of at most `capacity` tokens; full pieces are sequences of their own. The
other pieces are dealt at random to blocks of bounded size, and every block is packed on several
islands. An island breeds packings: crossover copies whole well-filled sequences of one parent into
the other, removes sequences that hold the same pieces again and puts displaced pieces where they
fit best. After each epoch an island's best packings move on to the next island of the block. What the
blocks leave in badly filled sequences is packed again, in blocks of its own.

Cases: null and empty texts are a piece of the end id alone; repeated rows are packed each; an empty
table gives no pieces; other columns are dropped. All pieces are placed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import batch, trimmed, written
from tablelift.llm.tokens import with_end

#: Pieces in a block, on average.
BLOCK = 4096
ISLANDS, EPOCHS, GENERATIONS, PARENTS, ELITES = 2, 2, 6, 6, 2
#: Generations where a packing is more than GAP over the lower bound: such pieces leave much to be won.
MANY_GENERATIONS, GAP = 60, 0.005
#: Displaced pieces whose pairs are tried at a time.
SWAPPED = 200

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _cut(tokenizer: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                ids, counts = with_end(tokenizer, part["text"], end_id)
                n_pieces = -(-counts // capacity)
                doc = np.repeat(np.arange(len(counts)), n_pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                # the first piece takes what the full ones leave
                short = (counts - 1) % capacity + 1
                start = np.where(piece > 0, short[doc] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, short[doc])
                data, begin = ids.astype("<u4").tobytes(), 4 * ((np.cumsum(counts) - counts)[doc] + start)
                crcs = [zlib.crc32(data[s:e]) for s, e in zip(begin.tolist(), (begin + 4 * length).tolist(), strict=True)]
                yield batch(_PIECES, part["doc_id"].take(pa.array(doc)), piece.astype(np.int32), start, length, crcs)

    return run


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and the end id, cut from the end."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(trimmed(_cut(tokenizer, end_id, capacity)), "doc_id long, piece int, start long, length long, ids_crc32 long")


class Block:
    """Packings of one block. A packing is an array with the sequence of each piece."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: int):
        self.lengths, self.capacity, self.random = lengths, capacity, np.random.default_rng(seed)
        self.least = -(-int(lengths.sum()) // capacity)

    def best_fit(self, packing: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Put the items, in their order, where the least room is left; new sequences where none has room."""
        used = packing[packing >= 0]
        names, dense = np.unique(used, return_inverse=True)
        packing = packing.copy()
        packing[packing >= 0] = dense
        room = self.capacity - np.bincount(dense, self.lengths[packing >= 0], len(names)).astype(int)
        stacks: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        for k, r in enumerate(room.tolist()):
            stacks[r].append(k)
        mask = sum(1 << r for r in range(self.capacity + 1) if stacks[r])
        n, chosen = len(names), []
        for size in self.lengths[items].tolist():
            fits = mask >> size
            if fits:
                r = size + (fits & -fits).bit_length() - 1
                k = stacks[r].pop()
                if not stacks[r]:
                    mask &= ~(1 << r)
            else:
                k, n, r = n, n + 1, self.capacity
            chosen.append(k)
            r -= size
            stacks[r].append(k)
            mask |= 1 << r
        packing[items] = chosen
        return packing

    def by_size(self, items: np.ndarray, noise: float = 0.0) -> np.ndarray:
        key = self.lengths[items] * (1 + noise * self.random.standard_normal(len(items)))
        return items[np.argsort(-key, kind="stable")]

    def first(self) -> list[np.ndarray]:
        empty, every = np.full(len(self.lengths), -1), np.arange(len(self.lengths))
        return [self.best_fit(empty, self.by_size(every, noise)) for noise in np.linspace(0, 0.3, PARENTS)]

    def fill(self, packing: np.ndarray) -> np.ndarray:
        return np.bincount(packing, self.lengths)

    def cost(self, packing: np.ndarray) -> tuple[int, float]:
        """Fewer sequences first, then fuller ones."""
        fill = self.fill(packing)
        return len(fill), -float(np.square(fill / self.capacity).sum())

    def cross(self, into: np.ndarray, donor: np.ndarray) -> np.ndarray:
        fill = self.fill(donor)
        good = (fill >= np.quantile(fill, 0.5)) & (self.random.random(len(fill)) < 0.5)
        injected = good[donor]
        hit = np.zeros(into.max() + 1, bool)
        hit[into[injected]] = True  # these hold injected pieces too
        worst = np.argsort(self.fill(into))[: max(1, len(hit) // 50)]
        hit[worst] = True
        child = np.where(injected, donor + len(hit), np.where(hit[into], -1, into))
        if len(fill) > self.least * (1 + GAP) + 1:
            child = self.swapped(child)
        return self.best_fit(child, self.by_size(np.flatnonzero(child < 0), 0.05))

    def swapped(self, packing: np.ndarray, rounds: int = 3) -> np.ndarray:
        """Exchange one or two pieces of a sequence for one or two displaced ones that fill it better, fullest first."""
        packing, none = packing.copy(), len(self.lengths)
        size = np.append(self.lengths, 0)
        for _ in range(rounds):
            free = np.flatnonzero(packing < 0)
            free = np.append(self.random.permutation(free)[:SWAPPED], none)  # none: one piece in place of two
            a, b = np.triu_indices(len(free), 1)
            a, b = free[a], free[b]
            offer = size[a] + size[b]
            by_offer = np.argsort(offer, kind="stable")
            a, b, offer = a[by_offer], b[by_offer], offer[by_offer]
            held = np.flatnonzero(packing >= 0)
            held = held[np.argsort(packing[held], kind="stable")]
            room = self.capacity - np.bincount(packing[held], self.lengths[held]).astype(int)
            # pieces that stand 1 or 2 places apart among those of their sequence, and each alone
            pairs = [(held, np.full(len(held), none))]
            for step in (1, 2):
                same = packing[held[:-step]] == packing[held[step:]]
                pairs.append((held[:-step][same], held[step:][same]))
            x, y = (np.concatenate(c) for c in zip(*pairs, strict=True))
            if not len(x) or not len(offer):
                break
            out = size[x] + size[y]
            most = out + room[packing[x]]
            best = np.searchsorted(offer, most, side="right") - 1
            gain = np.where(best >= 0, offer[best] - out, 0)
            order = np.lexsort((self.random.random(len(x)), most - offer[best]))
            order = order[gain[order] > 0]
            touched, taken, changed = set(), set(), 0
            for i in order.tolist():
                p, j = int(packing[x[i]]), best[i]
                new = {int(a[j]), int(b[j])} - {none}
                if p in touched or not new or new & taken:
                    continue
                touched.add(p)
                taken |= new
                for old in (int(x[i]), int(y[i])):
                    if old != none:
                        packing[old] = -1
                packing[list(new)] = p
                changed += 1
            if not changed:
                break
        return packing

    def breed(self, packings: list[np.ndarray], generations: int) -> list[np.ndarray]:
        ranked = sorted(packings, key=self.cost)
        done = 0
        while done < (MANY_GENERATIONS if self.cost(ranked[0])[0] > self.least * (1 + GAP) + 1 else generations):
            done += 1
            if self.cost(ranked[0])[0] <= self.least or len(ranked) < 2:
                break
            children = []
            for _ in range(len(ranked) // 2):
                a, b = self.random.choice(len(ranked), 2, replace=False)
                children.append(self.cross(ranked[a], ranked[b]))
            ranked = sorted([*ranked, *children], key=self.cost)[:PARENTS]
        return ranked


_ISLANDS = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("uids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("packings", pa.list_(pa.list_(pa.int32()))), ("sequences", pa.int32())])
ISLAND_ROWS = "block long, island int, uids array<bigint>, lengths array<int>, packings array<array<int>>, sequences int"


def _epoch(capacity: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                block = Block(np.array(r["lengths"], np.int64), capacity, seed=r["block"] * 1000 + r["island"] * 10 + epoch)
                known = [np.array(p) for p in r["packings"] or []]
                ranked = block.breed(known or block.first(), GENERATIONS)
                yield batch(_ISLANDS, [r["block"]], [r["island"]], [r["uids"]], [r["lengths"]], [[p.tolist() for p in ranked[:PARENTS]]], [block.cost(ranked[0])[0]])

    return run


_PLACES = pa.schema([("uid", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("filled", pa.int64()), ("length", pa.int32())])


def _places(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                packing, lengths = np.array(r["packing"]), np.array(r["lengths"], np.int64)
                order = np.argsort(packing, kind="stable")
                ends = np.cumsum(lengths[order])
                starts = ends - lengths[order]
                fill = np.bincount(packing, lengths).astype(np.int64)
                base = np.cumsum(fill) - fill
                at = np.empty(len(order), np.int64)
                at[order] = starts - base[packing[order]]
                yield batch(_PLACES, r["uids"], packing + (r["block"] << 24) + (level << 58), at, fill[packing], lengths.astype(np.int32))

    return run


def _packed(items: DataFrame, capacity: int, level: int) -> DataFrame:
    """uid, sequence_id, offset, filled, length of (uid, length)."""
    n = items.count()
    blocks = max(1, -(-n // BLOCK))
    dealt = items.groupBy(F.pmod(F.xxhash64("uid"), F.lit(blocks)).alias("block")).agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("items"))
    islands = dealt.select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("items.uid").alias("uids"), F.col("items.length").cast("array<int>").alias("lengths"), F.lit(None).cast("array<array<int>>").alias("packings"), F.lit(0).alias("sequences"))
    for epoch in range(EPOCHS):
        # small rows that stand for much work: as many partitions as there are islands, within reason
        spread = islands.repartition(min(blocks * ISLANDS, 2000), "block", "island")
        islands = written(spread.mapInArrow(trimmed(_epoch(capacity, epoch)), ISLAND_ROWS), f"islands{epoch}")
        if epoch < EPOCHS - 1:
            guests = islands.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"), F.slice("packings", 1, ELITES).alias("guests"))
            islands = islands.join(guests, ["block", "island"]).select("block", "island", "uids", "lengths", F.concat("packings", "guests").alias("packings"), "sequences")
    best = islands.groupBy("block").agg(F.min_by(F.struct("uids", "lengths", F.col("packings")[0].alias("packing")), F.struct("sequences", "island")).alias("best")).select("block", "best.*")
    return written(best.mapInArrow(trimmed(_places(level)), "uid long, sequence_id long, offset long, filled long, length int"), f"packed{level}")


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Every row of pieces (with a column length, at most capacity) with sequence_id and offset."""
    own = written(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = own.where(F.col("length") == capacity).select("*", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = own.where(F.col("length") < capacity).select("uid", F.col("length").cast("int").alias("length"))
    first = _packed(items, capacity, 1)
    loose = first.where(F.col("filled") < 0.97 * capacity)
    second = _packed(loose.select("uid", "length"), capacity, 2)
    placed = first.where(F.col("filled") >= 0.97 * capacity).unionByName(second).select("uid", "sequence_id", "offset")
    return full.unionByName(own.where(F.col("length") < capacity).join(placed, "uid")).drop("uid")
