"""An export: schema and queries to side files, splits to Avro files, metrics, validation; with a check of a
replica before it, or several times over as a benchmark."""

from __future__ import annotations

import json
import logging
import re
import threading
import time
import uuid
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession

from tablelift.errors import JobFailed
from tablelift.functions.conversion import avro_schema, export_columns, supplied_schema
from tablelift.operators.freshness import REPLICATION_SQL, check_replica, check_rows, last_replication
from tablelift.operators.metrics import bench_table, derived
from tablelift.operators.periods import parse_instant, parse_period
from tablelift.plans.options import Options
from tablelift.sources.avro import AvroSink
from tablelift.sources.files import read_text, save_below
from tablelift.sources.jdbc import Jdbc, Session, redacted, source_of
from tablelift.sources.secrets import KmsDecrypter, read_password

log = logging.getLogger("tablelift")

__all__ = ["Options", "export", "replica_export", "bench", "job_name", "open_source"]


def open_source(spark: SparkSession, options: Options, decrypter: KmsDecrypter | None = None) -> Jdbc | Session:
    if options.connection_url is None:
        return Session()
    log.info("connecting to %s as %s", redacted(options.connection_url), options.username)
    password = read_password(lambda p: read_text(spark, p), options.password_file_kms_encrypted, options.password_file, options.password, decrypter)
    return source_of(options.connection_url, username=options.username, password=password, fetch_size=options.fetch_size, commands=options.pre_command)


def job_name(given: str | None, *parts: str | None) -> str:
    """The name given, unless there is none or it is "auto": then tablelift, the parts in small letters and digits, and a random end."""
    if given not in (None, "auto"):
        return given
    known = [re.sub(r"[^a-z0-9]", "", p.lower()) for p in parts if p]
    return "-".join(["tablelift", *known, uuid.uuid4().hex[:8]])


def limited(spark: SparkSession, name: str, seconds: float, work) -> None:
    """Run work as a job group of this name; cancel its jobs after the time, as often as it takes."""
    ended, late = threading.Event(), threading.Event()

    def watch():
        if not ended.wait(min(seconds, threading.TIMEOUT_MAX)):
            late.set()
            while not ended.wait(0.2):
                spark.sparkContext.cancelJobGroup(name)

    spark.sparkContext.setJobGroup(name, name, interruptOnCancel=True)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        work()
    except Exception as e:
        raise JobFailed(f"cancelled after the time limit of {seconds:g} s" if late.is_set() else f"the export failed: {e}") from e
    finally:
        ended.set()
        watcher.join()
        for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            spark.sparkContext.setLocalProperty(key, None)


def _schema(spark: SparkSession, options: Options, source, base: DataFrame) -> str:
    url = redacted(options.connection_url) if options.connection_url else ""
    doc = options.avro_doc if options.avro_doc is not None else f"Schema of {url or 'a table of the session'}"
    name = options.avro_schema_name or (options.table or "").rsplit(".", 1)[-1]
    schema = avro_schema(base, name, options.avro_schema_namespace, doc, options.use_avro_logical_types, options.nullable_array_items, options.array_mode, url)
    if options.avro_schema_file_path:
        return supplied_schema(read_text(spark, options.avro_schema_file_path), schema)
    return schema


def save_metrics(spark: SparkSession, folder: str, metrics: dict[str, int]) -> None:
    """Both metrics files; an error of the file system is logged, as the data are written."""
    try:
        for name in ("/_METRICS.json", "/_SERVICE_METRICS.json"):
            save_below(spark, folder, name, json.dumps(metrics))
    except OSError:
        log.exception("metrics could not be saved")


def export(spark: SparkSession, options: Options, source=None, decrypter: KmsDecrypter | None = None) -> dict[str, int]:
    """Returns the metrics; the files stay if the number of rows is not accepted."""
    log.info("tablelift %s", options.version)
    query = options.query(read=lambda p: read_text(spark, p))
    source = source or open_source(spark, options, decrypter)
    root, began = options.output.rstrip("/"), time.time()
    base = source.frame(spark, query)
    schema = _schema(spark, options, source, base)
    schema_ms = int(1000 * (time.time() - began))
    queries = query.splits(spark, options.split_column, options.query_parallelism, source) if options.split_column else [query]
    name = job_name(options.job_name, source.catalog, options.table)
    texts = [source.text(q) for q in queries]
    if not options.data_only:
        save_below(spark, root, "/_AVRO_SCHEMA.avsc", schema)
        for i, text in enumerate(texts):
            save_below(spark, root, f"/_queries/query_{i}.sql", text)
    log.info("%s runs %s", name, texts)
    spark.dataSource.register(AvroSink)

    def write():
        rows = export_columns(source.rows(spark, queries), options.nullable_array_items, options.array_mode)
        rows.write.format("tablelift_avro").option("avroschema", schema).option("path", root).option("codec", options.avro_codec).mode("append").save()

    limited(spark, name, options.timeout, write)
    metrics = json.loads(read_text(spark, f"{root}/.committed"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/.committed")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
    metrics = derived(metrics | {"schemaElapsedTimeMs": schema_ms})
    if not options.data_only:
        save_metrics(spark, root, metrics)
    check_rows(metrics["recordCount"], options.min_rows)
    return metrics


def check_replica_options(source, options: Options) -> None:
    if not (isinstance(source, Jdbc) and "postgres" in source.options()["driver"]):
        raise ValueError("the replica check needs a PostgreSQL connection")
    if not options.partition:
        raise ValueError("the replica check needs a partition")


def replica_export(spark: SparkSession, options: Options, source=None, replication: DataFrame | None = None) -> dict[str, int]:
    """An export that begins once the replica has reached the end of the partition; NotReady before.

    `replication`: the answer of the replica, in place of asking it."""
    options.query(read=lambda p: read_text(spark, p))
    if replication is None:
        source = source or open_source(spark, options)
        check_replica_options(source, options)
        replication = source._load(spark, REPLICATION_SQL)
    elif not options.partition:
        raise ValueError("the replica check needs a partition")
    check_replica(last_replication(replication), parse_instant(options.partition), parse_period(options.partition_period))
    return export(spark, options, source)


def bench(spark: SparkSession, options: Options, source=None) -> tuple[DataFrame, str]:
    """`executions` exports below the output folder; their metrics as rows and as a table."""
    runs = [export(spark, replace(options, output=f"{options.output.rstrip('/')}/run_{i}"), source) for i in range(options.executions)]
    names = sorted({k for r in runs for k in r})
    rows = spark.createDataFrame([(i, *[r.get(k, 0) for k in names]) for i, r in enumerate(runs)], "run long, " + ", ".join(f"{k} long" for k in names))
    given = {k: v for k, v in asdict(options).items() if v is not None and k != "password"}
    if "connection_url" in given:
        given["connection_url"] = redacted(given["connection_url"])
    return rows, f"Options: {given}\n{bench_table(rows)}"
