"""Avro container files: a column-wise encoder and a Spark DataSource writer.

A batch is encoded a column at a time: the bytes of all its values and their lengths, with NumPy on Arrow's
buffers. The columns are then interleaved to rows by one scatter each.
"""

from __future__ import annotations

import json
import os
import struct
import time
import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tablelift import __version__
from tablelift.operators.metrics import counters, gauges, task_gauges

BLOCK_BYTES = 16 * 16_000


def parse_codec(text: str) -> tuple[str, int]:
    if text == "snappy":
        return "snappy", 0
    for name in ("deflate", "zstandard"):
        if text[: len(name)] == name and text[len(name) :] in set("123456789"):
            return name, int(text[len(name) :])
    raise ValueError(f"no codec: {text}; there are snappy, deflate1 to deflate9 and zstandard1 to zstandard9")


def _long(n: int) -> bytes:
    return varints(np.array([n], np.int64))[0].tobytes()


def _data(x: bytes) -> bytes:
    return _long(len(x)) + x


def scatter(sizes: list[np.ndarray], parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Interleave columns of byte strings (all bytes of a column, and the size of each value) to rows.

    Returns the bytes of the rows and the size of each row."""
    rows = sum(sizes)
    start = np.cumsum(rows) - rows
    out = np.empty(int(rows.sum()), np.uint8)
    for size, part in zip(sizes, parts, strict=True):
        if len(part):
            if len(part) == len(size) * int(size[0]) and (size == size[0]).all():
                width = int(size[0])
                out[start[:, None] + np.arange(width)] = part.reshape(-1, width)
            else:
                out[np.arange(len(part)) + np.repeat(start - (np.cumsum(size) - size), size)] = part
        start = start + size
    return out, rows


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zigzag varints of 64-bit integers: all bytes, and the size of each."""
    u = ((values << 1) ^ (values >> 63)).view(np.uint64)
    size = np.ones(len(u), np.int64)
    for k in range(1, 10):
        size += u >= np.uint64(1 << 7 * k)
    longest = int(size.max(initial=1))
    shifts = np.arange(longest, dtype=np.uint64) * np.uint64(7)
    groups = ((u[:, None] >> shifts) & np.uint64(0x7F)).astype(np.uint8)
    place = np.arange(longest)
    groups[place < size[:, None] - 1] |= 0x80
    return groups[place < size[:, None]], size


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of bytes, without a length; nulls are empty."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    size = np.diff(offsets)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    if column.null_count:
        valid = np.asarray(column.is_valid())
        data, size = data[np.repeat(valid, size)], np.where(valid, size, 0)
    return data, size


def _fixed(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1), np.full(len(values), width, np.int64)


def encode_values(kind, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values without nulls: all bytes, and the size of each."""
    name = kind["type"] if isinstance(kind, dict) else kind
    if name in ("int", "long"):
        return varints(np.asarray(column.cast(pa.int64())))
    if name == "double":
        return _fixed(np.asarray(column.cast(pa.float64())).astype("<f8"), 8)
    if name == "float":
        return _fixed(np.asarray(column.cast(pa.float32())).astype("<f4"), 4)
    if name == "boolean":
        return _fixed(np.asarray(column.cast(pa.uint8())), 1)
    if name in ("string", "bytes"):
        data, size = _bytes_of(column if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else column.cast(pa.large_string()))
        head, head_size = varints(size)
        return scatter([head_size, size], [head, data])[0], head_size + size
    # an array: a block of its number of items and the items, unless empty, and a block of none
    counts = np.asarray(pc.list_value_length(column)).astype(np.int64)
    items = column.flatten()
    inner = kind["items"]
    data, size = encode_column(inner[0], items, null_first=False) if isinstance(inner, list) else encode_values(inner, items)
    ends = np.concatenate([[0], np.cumsum(size)])
    stops = np.cumsum(counts)
    body = ends[stops] - ends[stops - counts]
    head, head_size = varints(counts)
    end_size = (counts > 0).astype(np.int64)
    return scatter([head_size, body, end_size], [head, data, np.zeros(int(end_size.sum()), np.uint8)])[0], head_size + body + end_size


def encode_column(kind, column: pa.Array, null_first: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A union of null and a type. Fields have null first, items of arrays have it second."""
    valid = np.ones(len(column), bool) if not column.null_count else np.asarray(column.is_valid())
    some, none = (2, 0) if null_first else (0, 2)
    head = np.where(valid, some, none).astype(np.uint8)
    data, dense = encode_values(kind, column.drop_null() if column.null_count else column)
    size = np.zeros(len(column), np.int64)
    size[valid] = dense
    return scatter([np.ones(len(column), np.int64), size], [head, data])[0], size + 1


def encode_batch(kinds: list, columns: list[pa.Array], n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows and the size of each."""
    if not columns or not n_rows:
        return np.zeros(0, np.uint8), np.zeros(n_rows, np.int64)
    encoded = [encode_column(k, c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c) for k, c in zip(kinds, columns, strict=True)]
    return scatter([size for _, size in encoded], [data for data, _ in encoded])


def compress(codec: str, level: int, data: bytes) -> bytes:
    if codec == "deflate":
        packer = zlib.compressobj(level, zlib.DEFLATED, -15)
        return packer.compress(data) + packer.flush()
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdCompressor(level=level).compress(data)
    return pa.Codec("snappy").compress(data, asbytes=True) + struct.pack(">I", zlib.crc32(data))


def file_system(path: str):
    """Arrow's file system of an address, and the path in it; a path without a scheme is a local one."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), os.path.abspath(path)


@dataclass
class Written(WriterCommitMessage):
    path: str
    counts: dict[str, int]
    last: list[tuple[str, float, int]] = field(default_factory=list)


class AvroWriter(DataSourceArrowWriter):
    """A file for each task under a name of its attempt; commit renames, as only then their number is known.

    An attempt that fails removes its file; what a lost executor leaves goes with the next commit or abort."""

    def __init__(self, schema: str, path: str, codec: str):
        self.schema, self.path, (self.codec, self.level) = schema, path.rstrip("/"), parse_codec(codec)
        self.job = uuid.uuid4().hex

    def write(self, batches):
        kinds = [f["type"][1] for f in json.loads(self.schema)["fields"]]
        system, root = file_system(self.path)
        system.create_dir(root, recursive=True)
        name, rows = f"{root}/.tmp-{self.job}-{uuid.uuid4().hex}.avro", 0
        sync = uuid.uuid4().bytes
        meta = {"avro.schema": self.schema.encode(), "avro.codec": self.codec.encode(), "created_by": f"tablelift {__version__}".encode()}
        began = time.monotonic()
        query_ms = None
        try:
            with system.open_output_stream(name) as out:
                out.write(b"Obj\1" + _long(len(meta)) + b"".join(_data(k.encode()) + _data(v) for k, v in meta.items()) + b"\0" + sync)
                held, n = [], 0

                def flush():
                    data = compress(self.codec, self.level, b"".join(held))
                    out.write(_long(n) + _data(data) + sync)

                size = 0
                for b in batches:
                    if query_ms is None:  # the first rows of the query are here
                        query_ms, began = int(1000 * (time.monotonic() - began)), time.monotonic()
                    data, sizes = encode_batch(kinds, b.columns, b.num_rows)
                    ends = np.cumsum(sizes)
                    at = row = 0
                    while row < b.num_rows:
                        # rows up to the one that fills the block
                        stop = min(int(np.searchsorted(ends, at + BLOCK_BYTES - size)) + 1, b.num_rows)
                        held.append(data[at : ends[stop - 1]].tobytes())
                        size += int(ends[stop - 1]) - at
                        n += stop - row
                        at, row = int(ends[stop - 1]), stop
                        if size >= BLOCK_BYTES:
                            flush()
                            rows, n, size = rows + n, 0, 0
                            held.clear()
                if n:
                    flush()
                    rows += n
                written = out.tell()
        except BaseException:
            system.delete_file(name)
            raise
        ms = int(1000 * (time.monotonic() - began))
        counts = {"recordCount": rows, "bytesWritten": written, "writeElapsedMs": ms, "executeQueryElapsedMs": query_ms or 0}
        return Written(name, counts, [(k, time.time(), v) for k, v in task_gauges(rows, ms).items()])

    def _left(self, keep=()):
        """Files that attempts of this job have left."""
        from pyarrow import fs

        system, root = file_system(self.path)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return system, [f.path for f in found if f.base_name.startswith(f".tmp-{self.job}-") and f.base_name not in keep]

    def commit(self, messages):
        """Name the files, and leave the metrics beside them for the job."""
        done = [m for m in messages if m is not None]
        system, left = self._left({os.path.basename(m.path) for m in done})
        root = file_system(self.path)[1]
        system.create_dir(root, recursive=True)
        for i, m in enumerate(done):
            system.move(m.path, f"{root}/part-{i:05d}-of-{len(done):05d}.avro")
        for path in left:
            system.delete_file(path)
        metrics = gauges(x for m in done for x in m.last) | counters(m.counts for m in done)
        with system.open_output_stream(f"{root}/.committed") as f:
            f.write(json.dumps({"recordCount": 0, "bytesWritten": 0} | metrics).encode())

    def abort(self, messages):
        system, left = self._left()
        for path in left:
            system.delete_file(path)


class AvroSink(DataSource):
    @classmethod
    def name(cls):
        return "tablelift_avro"

    def writer(self, schema, overwrite):
        return AvroWriter(self.options["avroschema"], self.options["path"], self.options.get("codec", "deflate6"))


def _snappy_size(packed: bytes) -> int:
    """The size that a snappy block says it has: a varint at its start."""
    size = shift = 0
    for b in packed:
        size |= (b & 0x7F) << shift
        shift += 7
        if b < 0x80:
            return size
    return size


def avro_rows(spark, folder: str, schema: str):
    """The rows of the files of a folder as a DataFrame: a file is decoded whole by one task."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def decode(batches):
        for b in batches:
            for content in b["content"].to_pylist():
                rows = read_container(content)[1]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.avro").load(folder)
    return files.select("content").mapInArrow(decode, schema)


def read_container(data: bytes) -> tuple[str, list[list]]:
    """Schema and rows of a file's bytes, decoded value by value: for checks of what is written here."""
    import zstandard

    place = 4

    def number():
        nonlocal place
        shift = n = 0
        while True:
            b = data[place]
            place += 1
            n |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return (n >> 1) ^ -(n & 1)

    def block():
        nonlocal place
        size = number()
        place += size
        return data[place - size : place]

    meta = {}
    for _ in range(number()):
        key = block()
        meta[key.decode()] = block()
    place += 17
    kinds = [f["type"][1] for f in json.loads(meta["avro.schema"])["fields"]]
    codec, whole, rows = meta["avro.codec"].decode(), data, []

    def value(kind):
        nonlocal place
        name = kind["type"] if isinstance(kind, dict) else kind
        if name in ("int", "long"):
            return number()
        if name in ("string", "bytes"):
            x = bytes(block())
            return x.decode() if name == "string" else x
        if name == "boolean":
            place += 1
            return bool(data[place - 1])
        if name in ("double", "float"):
            width = 8 if name == "double" else 4
            place += width
            return struct.unpack("<d" if width == 8 else "<f", data[place - width : place])[0]
        out = []
        while n := number():
            for _ in range(n):
                items = kind["items"]
                out.append((None if number() else value(items[0])) if isinstance(items, list) else value(items))
        return out

    while place < len(whole):
        n, packed = number(), block()
        resume = place + 16
        if codec == "deflate":
            data = zlib.decompress(packed, -15)
        elif codec == "zstandard":
            data = zstandard.ZstdDecompressor().decompressobj().decompress(packed)
        else:
            data = pa.Codec("snappy").decompress(packed[:-4], _snappy_size(packed), asbytes=True)
        place = 0
        for _ in range(n):
            rows.append([value(k) if number() else None for k in kinds])
        data, place = whole, resume
    return meta["avro.schema"].decode(), rows
