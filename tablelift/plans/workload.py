"""Registered queries of the export engine, and the same in DuckDB's SQL."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import functions as F

from tablelift.functions.conversion import avro_type, export_columns, normalized
from tablelift.operators import metrics
from tablelift.operators.freshness import enough, fresh_enough
from tablelift.operators.periods import Period, parse_instant, parse_period
from tablelift.operators.splits import bounds, ranges
from tablelift.plans.job import Options, export
from tablelift.plans.query import ExportQuery, register, union
from tablelift.sources import served
from tablelift.sources.avro import avro_rows
from tablelift.sources.jdbc import Jdbc, add_driver

TABLES = ["region", "nation", "customer", "orders", "lineitem", "events", "embeddings"]

CTE = "WITH t AS (SELECT o_custkey, SUM(o_totalprice) AS spent FROM orders GROUP BY o_custkey)\nSELECT o_custkey, round(spent, 2) AS spent FROM t;\n"
JOIN = "SELECT o.o_orderkey, c.c_name, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"
TOP = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"


def _partition(table, column, at, period):
    return ExportQuery.table(table).partition(column, parse_instant(at), parse_period(period))


#: Queries whose text runs unchanged on both sides.
TEXTS = {
    "scan_table": ExportQuery.table("nation"),
    "scan_user_query": ExportQuery.sql("SELECT n_name, n_regionkey FROM nation WHERE n_regionkey > 1;"),
    "scan_user_cte": ExportQuery.sql(CTE),
    "scan_user_join": ExportQuery.sql(JOIN),
    "partition_daily": _partition("events", "ts", "2024-01-05", None),
    "partition_monthly": _partition("lineitem", "l_shipdate", "1995-01-01", "P1M"),
    "partition_month_end": _partition("orders", "o_orderdate", "1995-01-31", "P1M"),
    "partition_hourly": _partition("events", "ts", "2024-01-05T00:00:00Z", "PT1H"),
    "partition_truncates_time": _partition("events", "ts", "2024-01-05T13:37:59Z", "P1D"),
    "limit_ordered": ExportQuery.sql(TOP),
}

RANGES_SQL = """
WITH b AS (SELECT MIN(l_orderkey) AS mn, MAX(l_orderkey) AS mx FROM lineitem),
s AS (SELECT mn, mx, GREATEST(CAST(CEIL((mx - mn) / CAST({p} AS DOUBLE)) AS BIGINT), 1) AS bs FROM b),
n AS (SELECT mn, mx, bs, GREATEST(CAST(CEIL((mx - mn) / CAST(bs AS DOUBLE)) AS BIGINT), 1) AS k FROM s)
SELECT i AS split_id, mn + i * bs AS start_incl, CASE WHEN i = k - 1 THEN mx ELSE mn + (i + 1) * bs END AS end_point, i < k - 1 AS end_excl
FROM (SELECT mn, mx, bs, k, UNNEST(range(k)) AS i FROM n)
"""
COUNTS_SQL = f"SELECT r.split_id, count(*) AS n FROM ({RANGES_SQL.format(p=7)}) r JOIN lineitem l ON l.l_orderkey >= r.start_incl AND (l.l_orderkey < r.end_point OR (NOT r.end_excl AND l.l_orderkey = r.end_point)) GROUP BY r.split_id"


def _text(name):
    def run(spark, sf_dir):
        register(spark, sf_dir, TABLES)
        return TEXTS[name].frame(spark)

    return run


def _ranges(p):
    def run(spark, sf_dir):
        register(spark, sf_dir, TABLES)
        found = ranges(*bounds(spark.table("lineitem"), "l_orderkey"), p)
        return spark.createDataFrame([(i, r.start, r.end, r.open_end) for i, r in enumerate(found)], "split_id long, start_incl long, end_point long, end_excl boolean")

    return run


def entry(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    return union(spark, TEXTS["partition_daily"].splits(spark, "event_id", 4))


def _bounds(query, column):
    def run(spark, sf_dir):
        register(spark, sf_dir, TABLES)
        return query.bounds(column).frame(spark)

    return run


def bounds_empty(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    found = bounds(spark.table("events").where("event_id < 0"), "event_id")
    return spark.createDataFrame([found], "min_s long, max_s long")


def split_scan(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    return union(spark, ExportQuery.table("lineitem").splits(spark, "l_orderkey", 4))


def split_partition(spark, sf_dir):
    return entry(spark, sf_dir)


def _split_counts(limit):
    def run(spark, sf_dir):
        register(spark, sf_dir, TABLES)
        queries = ExportQuery.table("lineitem").first(limit).splits(spark, "l_orderkey", 7)
        parts = [q.frame(spark).agg(F.count("*").alias("n")).select(F.lit(i).cast("long").alias("split_id"), "n") for i, q in enumerate(queries)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    return run


def split_limit_ranges(spark, sf_dir):
    """The limit is one of the row of the ends, so that ranges cover all rows."""
    register(spark, sf_dir, TABLES)
    queries = ExportQuery.table("lineitem").first(100).splits(spark, "l_orderkey", 4)
    return spark.createDataFrame([(i, q.split_by, q.limit) for i, q in enumerate(queries)], "split_id long, predicate string, n long")


def limit_count(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    return ExportQuery.table("events").first(7).frame(spark).agg(F.count("*").alias("n"))


def _convert(sql):
    def run(spark, sf_dir):
        register(spark, sf_dir, TABLES)
        return export_columns(spark.sql(sql))

    return run


def normalize_columns(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    return export_columns(spark.sql("SELECT n_nationkey AS `nation key`, n_name AS `näme-1` FROM nation"))


def schema_fields(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    fields = spark.table("events").schema
    return spark.createDataFrame([(normalized(f.name), str(avro_type(f.dataType))) for f in fields], "name string, avro_type string")


def array_typed(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    rows = export_columns(spark.table("embeddings"))
    return rows.select("vec_id", F.size("embedding").cast("long").alias("n"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 3).alias("total"))


def replica_freshness(spark, sf_dir):
    """For each day, whether events have come up to 23 hours of it."""
    register(spark, sf_dir, TABLES)
    days = spark.table("events").groupBy(F.to_date("ts").alias("day")).agg(F.max("ts").alias("last"))
    return days.select("day", fresh_enough(F.col("last"), F.col("day").cast("timestamp_ntz"), Period(seconds=23 * 3600)).alias("late_enough"))


def replica_freshness_monthly(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    days = spark.table("orders").groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.max("o_orderdate").alias("last"))
    return days.select("month", fresh_enough(F.col("last") + F.expr("INTERVAL 1 DAY"), F.col("month").cast("timestamp_ntz"), parse_period("P1M")).alias("late_enough"))


def min_rows_check(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    days = spark.table("events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return days.select("day", "n", enough(F.col("n"), F.lit(340)).alias("passed"))


def bench_stats(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    found = metrics.summary(spark.table("events"), ["value"], ["event_type"])
    return found.select("event_type", F.col("max_value").alias("max_v"), F.round("mean_value", 6).alias("mean_v"), F.col("min_value").alias("min_v"), F.round("stddev_value", 6).alias("stddev_v"))


def gauge_last_values(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    return metrics.last_values(spark.table("events").select("event_type", F.struct("ts", "event_id").alias("at"), "value"), "event_type", "at", "value")


def _remove(spark, folder: str) -> None:
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone; the folder then stays for the cluster's clean-up
        pass


def folder_for(spark=None) -> str:
    """A folder for the exports of these queries (they read them back on this machine), which goes at the end.

    With a session: below spark.checkpoint.dir, where all machines see it, if that is set."""
    base = spark and spark.conf.get("spark.checkpoint.dir", None)
    if base:
        folder = f"{base.rstrip('/')}/tablelift-export-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, folder)
        return folder
    folder = tempfile.mkdtemp(prefix="tablelift-export-")
    atexit.register(shutil.rmtree, folder, True)
    return folder


def exported(spark, **options):
    """Metrics of an export, and its folder."""
    folder = folder_for()
    return export(spark, Options(output=folder, **options)), folder


def metrics_record_count(spark, sf_dir):
    """The count that an export reports."""
    register(spark, sf_dir, TABLES)
    found, _ = exported(spark, table="lineitem", split_column="l_orderkey", query_parallelism=4, avro_codec="zstandard1")
    return spark.createDataFrame([(found["recordCount"],)], "record_count long")


def avro_round_trip(spark, sf_dir):
    """orders, written to Avro files in four splits and read again."""
    register(spark, sf_dir, TABLES)
    _, folder = exported(spark, table="orders", split_column="o_orderkey", query_parallelism=4)
    return avro_rows(spark, folder, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate long, o_orderpriority string")


def avro_round_trip_arrays(spark, sf_dir):
    """Arrays with null items and null arrays."""
    register(spark, sf_dir, TABLES)
    _, folder = exported(spark, sql=ARRAYS, nullable_array_items=True, avro_codec="zstandard3")
    return avro_rows(spark, folder, "k int, xs array<int>, names array<string>").select("k", *[F.concat_ws(",", F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit("-")))).alias(c) for c in ("xs", "names")], F.col("xs").isNull().alias("missing"))


ARRAYS = "SELECT n_nationkey AS k, IF(n_nationkey % 5 = 0, NULL, array(n_regionkey, NULL, n_nationkey)) AS xs, array(n_name, NULL) AS names FROM nation"


def array_null_items(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    rows = spark.sql("SELECT vec_id, transform(embedding, (x, i) -> IF(i % 7 = 3, NULL, x)) AS items FROM embeddings")
    items = export_columns(rows, nullable_items=True)
    return items.select("vec_id", F.size("items").cast("long").alias("n"), F.size(F.filter("items", lambda x: x.isNull())).cast("long").alias("n_null"))


def array_bytes(spark, sf_dir):
    register(spark, sf_dir, TABLES)
    return export_columns(spark.sql(ARRAYS), mode="bytes").select("k", F.col("xs").cast("string").alias("xs"), F.col("names").cast("string").alias("names"))


def derby(spark, sf_dir, table, rows):
    """A table of an embedded database that the driver serves. It stands for a real one where none can be reached:
    tasks load and read it by connections, on whatever machine they run."""
    add_driver("derby", served.DRIVER, "FETCH FIRST {n} ROWS ONLY")
    url = served.serve(spark)
    rows = rows.toDF(*[c.upper() for c in rows.columns])
    rows.coalesce(1).write.format("jdbc").option("url", url).option("driver", served.DRIVER).option("dbtable", table).option("batchsize", 5000).mode("append").save()
    return Jdbc(url, username="app", password="app")


def _lower(rows):
    return rows.toDF(*[c.lower() for c in rows.columns])


def jdbc_scan(spark, sf_dir):
    """A user query that runs in a database."""
    source = derby(spark, sf_dir, "customer", spark.read.parquet(f"{sf_dir}/customer.parquet"))
    return _lower(source.rows(spark, [ExportQuery.sql("SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey < 5;")]))


def jdbc_split_scan(spark, sf_dir):
    """Four ranges of a partition of a table in a database, with the ends asked of the database."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet")
    source = derby(spark, sf_dir, "orders", rows.withColumn("o_orderdate", F.to_date("o_orderdate")))
    query = _partition("orders", "o_orderdate", "1996-03-01", "P1M")
    return _lower(source.rows(spark, query.splits(spark, "o_orderkey", 4, source))).withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


def jdbc_export(spark, sf_dir):
    """The same with a limit, as a whole export: rows that it reports, and rows in its files."""
    source = derby(spark, sf_dir, "orders", spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice"))
    folder = folder_for(spark)
    found = export(spark, Options(output=folder, table="orders", split_column="o_orderkey", query_parallelism=3, limit=30), source)
    kept = avro_rows(spark, folder, "o_orderkey long, o_totalprice double").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("n_keys"))
    return kept.withColumn("record_count", F.lit(found["recordCount"]).cast("long"))


MONTH = _partition("lineitem", "l_shipdate", "1995-01-01", "P1M")


def queries():
    out = {name: _text(name) for name in TEXTS}
    out |= {"ranges_even": _ranges(4), "ranges_uneven": _ranges(7), "ranges_wide": _ranges(100)}
    out |= {"bounds": _bounds(ExportQuery.table("lineitem"), "l_orderkey"), "bounds_partitioned": _bounds(MONTH, "l_orderkey"), "bounds_empty": bounds_empty}
    out |= {"split_scan": split_scan, "split_partition": split_partition, "split_counts": _split_counts(None), "split_limit_counts": _split_counts(100), "split_limit_ranges": split_limit_ranges, "limit_count": limit_count}
    out |= {"convert_timestamps": _convert("SELECT event_id, ts FROM events"), "convert_dates": _convert("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders"), "convert_decimal_string": _convert("SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)) AS price FROM lineitem"), "convert_ints": _convert("SELECT p_key AS k, CAST(p_key AS SMALLINT) AS s, CAST(p_key AS TINYINT) AS t FROM (SELECT n_nationkey AS p_key FROM nation)")}
    out |= {"array_typed": array_typed, "normalize_columns": normalize_columns, "schema_fields": schema_fields, "replica_freshness": replica_freshness, "min_rows_check": min_rows_check, "bench_stats": bench_stats, "metrics_record_count": metrics_record_count}
    out |= {f.__name__: f for f in (replica_freshness_monthly, gauge_last_values, avro_round_trip, avro_round_trip_arrays, array_null_items, array_bytes, jdbc_scan, jdbc_split_scan, jdbc_export)}
    out |= {"convert_default_strings": _convert("SELECT event_id, make_dt_interval(CAST(event_id % 5 AS INT)) IS NULL AS none, CAST(event_id AS DECIMAL(20,0)) AS d, CAST(value AS FLOAT) AS f FROM events")}
    return out


def oracle_sql():
    out = {name: q.text() for name, q in TEXTS.items()}
    out |= {"ranges_even": RANGES_SQL.format(p=4), "ranges_uneven": RANGES_SQL.format(p=7), "ranges_wide": RANGES_SQL.format(p=100)}
    out |= {"bounds": "SELECT MIN(l_orderkey) AS min_s, MAX(l_orderkey) AS max_s FROM lineitem", "bounds_partitioned": MONTH.bounds("l_orderkey").text(), "bounds_empty": "SELECT COALESCE(MIN(event_id), 0) AS min_s, COALESCE(MAX(event_id), 0) AS max_s FROM events WHERE event_id < 0"}
    out |= {"split_scan": "SELECT * FROM lineitem", "split_partition": TEXTS["partition_daily"].text(), "split_counts": COUNTS_SQL, "split_limit_counts": f"SELECT split_id, LEAST(n, 14) AS n FROM ({COUNTS_SQL})", "limit_count": "SELECT LEAST(count(*), 7) AS n FROM events"}
    out |= {"convert_timestamps": "SELECT event_id, epoch_us(ts) // 1000 AS ts FROM events", "convert_dates": "SELECT o_orderkey, epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) // 1000 AS day FROM orders", "convert_decimal_string": "SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price FROM lineitem", "convert_ints": "SELECT n_nationkey AS k, n_nationkey AS s, n_nationkey AS t FROM nation"}
    out |= {"array_typed": "SELECT vec_id, len(embedding) AS n, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 3) AS total FROM embeddings", "normalize_columns": "SELECT n_nationkey AS nation_key, n_name AS n_me_1 FROM nation", "schema_fields": "SELECT * FROM (VALUES ('event_id','long'),('ts','long'),('user_id','long'),('event_type','string'),('value','double'),('props','string')) t(name, avro_type)"}
    out |= {"replica_freshness": "SELECT CAST(ts AS DATE) AS day, max(ts) >= CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 23 HOURS AS late_enough FROM events GROUP BY CAST(ts AS DATE)", "min_rows_check": "SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) >= 340 AS passed FROM events GROUP BY CAST(ts AS DATE)", "bench_stats": "SELECT event_type, max(value) AS max_v, round(avg(value), 6) AS mean_v, min(value) AS min_v, round(stddev_pop(value), 6) AS stddev_v FROM events GROUP BY event_type", "metrics_record_count": "SELECT count(*) AS record_count FROM lineitem"}
    out |= {"split_limit_ranges": f"SELECT split_id, 'l_orderkey >= ' || start_incl || ' AND l_orderkey ' || CASE WHEN end_excl THEN '<' ELSE '<=' END || ' ' || end_point AS predicate, 25 AS n FROM ({RANGES_SQL.format(p=4)})"}
    out |= {"replica_freshness_monthly": "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, max(o_orderdate) + INTERVAL 1 DAY >= date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS late_enough FROM orders GROUP BY date_trunc('month', o_orderdate)"}
    out |= {"gauge_last_values": "SELECT event_type, arg_max(value, (epoch_us(ts), event_id)) AS value FROM events GROUP BY event_type"}
    out |= {"avro_round_trip": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, epoch_us(o_orderdate) // 1000 AS o_orderdate, o_orderpriority FROM orders"}
    out |= {"avro_round_trip_arrays": "SELECT n_nationkey AS k, CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE n_regionkey || ',-,' || n_nationkey END AS xs, n_name || ',-' AS names, n_nationkey % 5 = 0 AS missing FROM nation"}
    out |= {"array_null_items": "SELECT vec_id, len(embedding) AS n, len(list_filter(range(len(embedding)), lambda i: i % 7 = 3)) AS n_null FROM embeddings"}
    out |= {"array_bytes": "SELECT n_nationkey AS k, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE '{' || n_regionkey || ',NULL,' || n_nationkey || '}' END AS xs, '{' || CASE WHEN contains(n_name, ' ') THEN '\"' || n_name || '\"' ELSE n_name END || ',NULL}' AS names FROM nation"}
    out |= {"jdbc_scan": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey < 5", "jdbc_split_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= '1996-03-01' AND o_orderdate < '1996-04-01'", "jdbc_export": "SELECT 30 AS n, 30 AS n_keys, 30 AS record_count"}
    out |= {"convert_default_strings": "SELECT event_id, false AS none, CAST(event_id AS VARCHAR) AS d, CAST(value AS FLOAT) AS f FROM events"}
    return out
