"""Shared helpers: the shared folder, written intermediate tables and Arrow plumbing."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes the shuffle files of a query at its end; what is written is not shuffled again.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW = "spark.sql.execution.arrow."


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a temporary folder
    in local mode, where there is one machine, and a folder of the warehouse on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        local = spark.sparkContext.master.startswith("local")
        base = tempfile.mkdtemp(prefix="tablelift-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tablelift"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone; the folder then stays for the cluster's clean-up
        pass


#: Scratch folders that this process has named and not removed.
_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/tablelift-{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(lambda: [_remove(spark, p) for p in _scratch])
    _scratch.append(path)
    return path


def scratch_folders() -> frozenset[str]:
    return frozenset(_scratch)


def drop_since(before: frozenset[str], *kept: DataFrame) -> None:
    """Remove the scratch folders that are not among `before`, but for those of written() frames that are still read."""
    held = before | {df._scratch for df in kept}
    for path in [p for p in _scratch if p not in held]:
        _remove(kept[0].sparkSession, path)
        _scratch.remove(path)


#: Bytes and rows of a batch that goes to Python, so that a worker holds little whatever the rows are.
BATCH_BYTES, BATCH_ROWS = 16 << 20, 2000


@contextlib.contextmanager
def settings(spark: SparkSession, **values):
    """Session settings for what is planned inside."""
    names = {k: str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors.

    `batch_rows`: rows of a batch that goes to Python; few where a row is large."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with settings(spark, **{SHUFFLE_CLEANUP: "true", ARROW + "maxRecordsPerBatch": batch_rows, ARROW + "maxBytesPerBatch": BATCH_BYTES}):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_written(*frames: DataFrame) -> None:
    """Remove the files of written(); only once nothing reads them any more."""
    for df in frames:
        _remove(df.sparkSession, df._scratch)
        _scratch.remove(df._scratch)


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs under the names c0, c1, ..., so that no column of theirs can clash, and those of doc_id, text, lang and n_chars."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), {c: names[docs.columns.index(c)] for c in ("doc_id", "text", "lang", "n_chars") if c in docs.columns}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def _trim() -> None:
    """Give memory that is free back to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # another C library
            pass


def trimmed(run):
    """A function of batches for mapInArrow() that leaves no free memory behind in its worker."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _trim()

    return wrapped


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
