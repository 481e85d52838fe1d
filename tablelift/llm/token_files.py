"""Token-id files of directly addressable codes, and their reader.

A segment holds the ids of some whole documents. Ids are cut into chunks of CHUNK_BITS bits; level j
holds chunk j of every id that has more than j chunks, in order, and a continuation bitmap that says
which of them go on. A rank directory has the set bits before every 512 bits of a bitmap, so that
the chunk of an id on the next level is found by one rank: any token is read without decoding others.

A token file is a Parquet table with a row for each segment (shard, segment, start of its ids in the
shard, directory of its documents, codes); Spark's commit makes a lost executor's half-written
shards vanish. Shards are ranges of doc_id, and documents are in ascending order of doc_id (null
first), rows with the same doc_id in order of their text.

Cases: null and empty texts have the end id only; an empty table gives an empty file; repeated rows
are documents of their own; other columns are left out of the file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm.common import batch, trimmed
from tablelift.llm.tokens import with_end

CHUNK_BITS = 8
RANK_BITS = 512
#: Ids after which a segment ends; a longer document has a segment of its own.
SEGMENT_IDS = 1 << 16
#: Size of a row group of the file; a segment takes some 140 kB.
ROW_GROUP_BYTES = 1 << 19


class Levels:
    """Codes of one segment."""

    def __init__(self, chunks: list[np.ndarray], bits: list[np.ndarray]):
        self.chunks, self.bits = chunks, bits
        self.ranks = []
        for b in bits:
            pad = np.zeros(-(-len(b) * 8 // RANK_BITS) * RANK_BITS // 8, np.uint8)
            pad[: len(b)] = b
            counts = np.unpackbits(pad).reshape(-1, RANK_BITS).sum(axis=1, dtype=np.uint32)
            self.ranks.append(np.concatenate([[0], np.cumsum(counts)]).astype("<u4"))

    @classmethod
    def of(cls, ids: np.ndarray) -> Levels:
        chunks, bits, rest = [], [], ids.astype(np.uint32)
        while len(rest) or not chunks:
            chunks.append((rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8))
            rest = rest >> CHUNK_BITS
            more = rest > 0
            bits.append(np.packbits(more))
            rest = rest[more]
        return cls(chunks, bits)

    def to_bytes(self) -> bytes:
        head = [len(self.chunks), *map(len, self.chunks)]
        parts = [np.array(head, "<u4").tobytes()]
        for c, b, r in zip(self.chunks, self.bits, self.ranks, strict=True):
            parts += [c.tobytes(), b.tobytes(), r.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Levels:
        """The rank directories are read from the file, not built again."""
        n = int(np.frombuffer(data, "<u4", 1)[0])
        sizes, at, out = np.frombuffer(data, "<u4", n, 4), 4 + 4 * n, cls([], [])
        for size in map(int, sizes):
            held = -(-size // 8)
            ranks = -(-held * 8 // RANK_BITS) + 1
            out.chunks.append(np.frombuffer(data, np.uint8, size, at))
            out.bits.append(np.frombuffer(data, np.uint8, held, at + size))
            out.ranks.append(np.frombuffer(data, "<u4", ranks, at + size + held))
            at += size + held + 4 * ranks
        return out

    def ids(self) -> np.ndarray:
        """All ids, from the last level up."""
        above = np.zeros(0, np.uint32)
        for chunk, bits in zip(reversed(self.chunks), reversed(self.bits), strict=True):
            ids = chunk.astype(np.uint32)
            if len(above):
                ids[np.unpackbits(bits, count=len(chunk)).view(bool)] |= above << CHUNK_BITS
            above = ids
        return above

    def at(self, i: int) -> int:
        """One id, by a rank on each level."""
        out = 0
        for level, (chunk, bits, ranks) in enumerate(zip(self.chunks, self.bits, self.ranks, strict=True)):
            out |= int(chunk[i]) << (CHUNK_BITS * level)
            if not bits[i >> 3] >> (7 - (i & 7)) & 1:
                break
            start = i // RANK_BITS * RANK_BITS
            i = int(ranks[i // RANK_BITS]) + int(np.unpackbits(bits[start >> 3 : (i >> 3) + 1])[: i - start].sum())
        return out


SEGMENTS = "shard int, segment int, shard_start long, n_ids long, doc_ids array<bigint>, doc_sizes array<bigint>, codes binary"
_SEGMENTS = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("shard_start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())), ("codes", pa.binary())])


def _segments(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, start = TaskContext.get().partitionId(), 0, 0
        docs, sizes, held, count = [], [], [], 0

        def segment_row():
            ids = np.concatenate(held)
            return batch(_SEGMENTS, [shard], [segment], [start], [len(ids)], [docs], [sizes], [Levels.of(ids).to_bytes()])

        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                ids, counts = with_end(tokenizer, part["text"], end_id)
                names, ends, first = part["doc_id"].to_pylist(), np.cumsum(counts), 0
                while first < len(names):
                    # documents up to the one that fills the segment
                    before = int(ends[first - 1]) if first else 0
                    stop = min(int(np.searchsorted(ends, before + SEGMENT_IDS - count)) + 1, len(names))
                    docs += names[first:stop]
                    sizes += counts[first:stop].tolist()
                    held.append(ids[before : ends[stop - 1]])
                    count += int(ends[stop - 1]) - before
                    first = stop
                    if count >= SEGMENT_IDS:
                        yield segment_row()
                        segment, start = segment + 1, start + count
                        docs, sizes, held, count = [], [], [], 0
        if docs:
            yield segment_row()

    return run


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode whole texts and write their ids, an end id after each document, in ascending doc_id order."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranges = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    ordered = ranges.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    segments = ordered.mapInArrow(trimmed(_segments(tokenizer, end_id)), SEGMENTS)
    # small row groups, so that one token is read without the codes of other segments
    segments.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


_DOCS = pa.schema([("shard", pa.int32()), ("place", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
_DIGESTS = pa.schema([*list(_DOCS)[:-1], pa.field("ids_crc32", pa.int64())])


def _decoded(digest: bool):
    schema = _DIGESTS if digest else _DOCS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                sizes = np.asarray(row["doc_sizes"][0].values, dtype=np.int64)
                data = Levels.from_bytes(row["codes"][0].as_py()).ids().astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                starts = ends - sizes
                spans = [data[4 * s : 4 * e] for s, e in zip(starts, ends, strict=True)]
                last = [zlib.crc32(x) for x in spans] if digest else spans
                yield batch(schema, np.full(len(sizes), row["shard"][0].as_py(), np.int32), starts + row["shard_start"][0].as_py(), row["doc_ids"][0].values, sizes, last)

    return run


def _starts(files: DataFrame) -> DataFrame:
    """For each shard the ids before it. A row for each shard, however large the shards are."""
    from pyspark.sql import Window

    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_base"))


def read_token_file(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, and ids (little-endian unsigned 32-bit)
    or, with digest, ids_crc32."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    kind = "shard int, place long, doc_id long, n_tokens long, " + ("ids_crc32 long" if digest else "ids binary")
    docs = files.select("shard", "shard_start", "doc_ids", "doc_sizes", "codes").mapInArrow(trimmed(_decoded(digest)), kind)
    # one row for each of the file's shards, of which there are as many as write_token_file() had partitions
    joined = docs.join(F.broadcast(_starts(files)), "shard")
    return joined.select("doc_id", (F.col("shard_base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32" if digest else "ids")


def read_token(spark: SparkSession, path: str, position: int) -> int:
    """The id at a position of the whole file. The sizes of segments say which one holds it; the codes of that
    segment alone are read, by conditions that reach the Parquet scan, and none is decoded."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    place = F.lit(position) - F.col("shard_base") - F.col("shard_start")
    held = files.select("shard", "segment", "shard_start", "n_ids").join(F.broadcast(_starts(files)), "shard").where((place >= 0) & (place < F.col("n_ids"))).select("shard", "segment", place.alias("i")).head()
    if held is None:
        raise IndexError(position)
    return Levels.from_bytes(bytes(segment_codes(files, held["shard"], held["segment"]).head()["codes"])).at(int(held["i"]))


def segment_codes(files: DataFrame, shard: int, segment: int) -> DataFrame:
    return files.where((F.col("shard") == shard) & (F.col("segment") == segment)).select("codes")
