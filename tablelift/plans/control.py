"""Registered queries that run the operators around an export (options, periods, secrets, side files, validation,
exit codes, replica checks, the benchmark) and return what they decide as rows, with the same in SQL."""

from __future__ import annotations

import base64
import glob
import json
import os
import time
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tablelift.__main__ import run as command_line
from tablelift.errors import exit_code
from tablelift.functions.conversion import ARRAY_MODES, avro_schema, avro_type, supplied_schema
from tablelift.operators import metrics
from tablelift.operators.freshness import REPLICATION_SQL, is_late, last_replication
from tablelift.operators.periods import check_age, parse_duration, parse_instant, parse_period
from tablelift.operators.splits import check_split_type
from tablelift.plans import job
from tablelift.plans.options import Options, parse
from tablelift.plans.query import ExportQuery, register, tidy
from tablelift.plans.workload import TABLES, derby, exported, folder_for
from tablelift.sources.avro import avro_rows, parse_codec
from tablelift.sources.files import read_text, write_text
from tablelift.sources.jdbc import Jdbc, Session, catalog_of, driver_class, redacted
from tablelift.sources.secrets import KmsDecrypter, read_password


def _code(work) -> int:
    """The exit code of a piece of work; 0 if it ends well."""
    try:
        work()
    except Exception as e:
        return exit_code(e)
    return 0


def parse_partitions(spark, sf_dir):
    texts = ["2027", "2027-05", "2027-07-31", "2027-07-31T23", "2027-07-31T23:10", "2027-07-31t23:10:05", "2027-07-31T23:10:05+02:00", "2027-02-30", "2027Z"]
    return spark.createDataFrame([(t, int(parse_instant(t).timestamp())) for t in texts], "text string, seconds long")


def period_ends(spark, sf_dir):
    """The end of a month's period that begins on each day of the table."""
    days = [r[0] for r in spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("day")).distinct().collect()]  # some years of days
    month, hours = parse_period("P1M"), parse_period("PT36H")
    at = lambda d: datetime(d.year, d.month, d.day, tzinfo=timezone.utc)
    return spark.createDataFrame([(d, month.after(at(d)).date(), int(hours.after(at(d)).timestamp())) for d in days], "day date, month_end date, hours_end long")


def partition_ages(spark, sf_dir):
    """Which days of the table pass the age check of a given day, and that of a least partition."""
    days = [str(r[0]) for r in spark.read.parquet(f"{sf_dir}/events.parquet").select(F.to_date("ts").alias("day")).distinct().collect()]
    now, least = parse_instant("2024-01-20T12"), parse_instant("2024-01-10")
    return spark.createDataFrame([(d, _code(lambda d=d: check_age(parse_instant(d), parse_period(None), now)), _code(lambda d=d: check_age(parse_instant(d), parse_period(None), now, least))) for d in days], "day string, code long, least_code long")


def option_checks(spark, sf_dir):
    """Exit codes of combinations of options."""
    url = ["--connectionUrl=jdbc:postgresql://h/db", "--output=/o"]
    cases = {"table": ["--table=t"], "both": ["--table=t", "--sqlFile=f"], "neither": [], "bad table": ["--table=a-b"], "split alone": ["--table=t", "--splitColumn=c"], "parallelism 0": ["--table=t", "--splitColumn=c", "--queryParallelism=0"], "column alone": ["--table=t", "--partitionColumn=c"], "bad codec": ["--table=t", "--avroCodec=deflate0"], "bad mode": ["--table=t", "--arrayMode=odd"], "bad period": ["--table=t", "--partition=2027-01-01", "--partitionPeriod=P1DT1H"], "unknown": ["--table=t", "--odd=1"], "bad time limit": ["--table=t", "--exportTimeout=P1M"]}
    rows = [(name, _code(lambda a=a: parse([*url, *a]).query(read=lambda p: "SELECT 1"))) for name, a in cases.items()]
    return spark.createDataFrame([*rows, ("no output", _code(lambda: parse(["--connectionUrl=u", "--table=t"]))), ("no address", _code(lambda: parse(["--output=/o", "--table=t"])))], "name string, code long")


def option_defaults(spark, sf_dir):
    o = parse(["--connectionUrl=jdbc:h2:mem:x", "--output=/o", "--table=t"])
    names = ["avro_codec", "fetch_size", "export_timeout", "min_rows", "array_mode", "executions", "data_only", "skip_partition_check", "nullable_array_items", "use_avro_logical_types"]
    return spark.createDataFrame([(n, str(getattr(o, n)).lower()) for n in names], "name string, value string")


def durations(spark, sf_dir):
    return spark.createDataFrame([(t, parse_duration(t).total_seconds()) for t in ("P7D", "PT1H30M", "P1DT12H", "PT0.5S")], "text string, seconds double")


def codecs(spark, sf_dir):
    """Codec names, and rows that an export with each brings back."""
    register(spark, sf_dir, TABLES)
    out = []
    for c in ("snappy", "deflate1", "deflate9", "zstandard1", "zstandard9"):
        _, folder = exported(spark, table="nation", avro_codec=c)
        out.append((c, *parse_codec(c), avro_rows(spark, folder, "n_nationkey int, n_name string, n_regionkey int").agg(F.sum("n_nationkey")).head()[0]))
    return spark.createDataFrame(out, "codec string, name string, level long, total long")


def sql_clean_up(spark, sf_dir):
    texts = ["SELECT 1;", "SELECT 1; \n", "SELECT 1;;", "SELECT ';' AS x", "SELECT '--' AS x"]
    return spark.createDataFrame([(i, tidy(t), ExportQuery.sql(t).first(1).text()) for i, t in enumerate(texts)], "i long, tidied string, wrapped string")


def sql_file_export(spark, sf_dir):
    """A query from a file, exported by the command line."""
    folder = folder_for()
    write_text(spark, f"{folder}/q.sql", "-- customers\nSELECT c_custkey, c_mktsegment FROM customer\nWHERE c_nationkey = 3;\n")
    code = command_line(["export", f"--connectionUrl=parquet:{sf_dir}", f"--sqlFile={folder}/q.sql", f"--output={folder}/out", "--minRows=1"], spark)
    rows = avro_rows(spark, f"{folder}/out", "c_custkey long, c_mktsegment string")
    return rows.withColumn("code", F.lit(code).cast("long"))


def command_line_codes(spark, sf_dir):
    """Exit codes of runs of the command line."""
    folder = folder_for()
    at = [f"--connectionUrl=parquet:{sf_dir}", "--table=region"]
    cases = {"done": [*at, f"--output={folder}/a"], "too few rows": [*at, f"--output={folder}/b", "--minRows=6"], "no table": [at[0], "--table=nothing", f"--output={folder}/c"], "no file": [at[0], f"--sqlFile={folder}/none", f"--output={folder}/d"], "no database": ["--connectionUrl=jdbc:odd:x", "--table=t", f"--output={folder}/e"], "not a replica": ["replica-export", *at, f"--output={folder}/f", "--partition=2027-01-01", "--skipPartitionCheck"], "late": [*at, f"--output={folder}/g", "--partition=2001-01-01"]}
    return spark.createDataFrame([(n, command_line(a, spark)) for n, a in cases.items()], "name string, code long")


def _files(folder):
    return sorted(os.path.relpath(f, folder) for f in glob.glob(f"{folder}/**", recursive=True) if os.path.isfile(f))


def side_files(spark, sf_dir):
    """Files of a whole export and of one of data only."""
    register(spark, sf_dir, TABLES)
    _, whole = exported(spark, table="region", split_column="r_regionkey", query_parallelism=2)
    _, data = exported(spark, table="region", data_only=True)
    return spark.createDataFrame([(k, f) for k, folder in (("whole", whole), ("data", data)) for f in _files(folder)], "kind string, file string")


def query_files(spark, sf_dir):
    """Texts of the query files of a split export of a partition."""
    register(spark, sf_dir, TABLES)
    _, folder = exported(spark, table="lineitem", partition="1995-01-31", partition_column="l_shipdate", partition_period="P1M", split_column="l_orderkey", query_parallelism=3)
    return spark.createDataFrame([(i, read_text(spark, f"{folder}/_queries/query_{i}.sql")) for i in range(3)], "i long, text string")


def schema_files(spark, sf_dir):
    """Fields of the schema file, with logical types."""
    register(spark, sf_dir, TABLES)
    _, folder = exported(spark, sql="SELECT o_orderkey, o_orderdate, o_orderstatus AS `order status` FROM orders LIMIT 3", use_avro_logical_types=True, avro_schema_name="Orders", avro_schema_namespace="shop", avro_doc="Some orders")
    schema = json.loads(read_text(spark, f"{folder}/_AVRO_SCHEMA.avsc"))
    return spark.createDataFrame([(f["name"], json.dumps(f["type"]), f["columnName"], f"{schema['namespace']}.{schema['name']}", schema["doc"]) for f in schema["fields"]], "name string, kind string, column string, record string, doc string")


def supplied_schemas(spark, sf_dir):
    """Exit codes of exports with supplied schemas, and the document of the one that is taken."""
    register(spark, sf_dir, TABLES)
    folder = folder_for()
    generated = json.loads(avro_schema(spark.table("region"), "region"))
    files = {"taken": json.dumps(generated | {"doc": "supplied"}), "no JSON": "{", "no unions": json.dumps(generated | {"fields": [f | {"type": f["type"][1]} for f in generated["fields"]]}), "too few fields": json.dumps(generated | {"fields": generated["fields"][:1]})}
    rows = []
    for name, text in files.items():
        write_text(spark, f"{folder}/{name}.avsc", text)
        rows.append((name, _code(lambda name=name: exported(spark, table="region", avro_schema_file_path=f"{folder}/{name}.avsc"))))
    rows.append(("no file", _code(lambda: exported(spark, table="region", avro_schema_file_path=f"{folder}/none.avsc"))))
    document = json.loads(supplied_schema(files["taken"], json.dumps(generated)))["doc"]
    return spark.createDataFrame([(*r, document) for r in rows], "name string, code long, doc string")


def min_rows_export(spark, sf_dir):
    """Exit codes with a least number of rows, and whether the data files stay."""
    register(spark, sf_dir, TABLES)
    out = []
    for least in (-1, 25, 26):
        folder = folder_for()
        code = _code(lambda least=least, folder=folder: job.export(spark, Options(output=folder, table="nation", min_rows=least)))
        out.append((least, code, len(glob.glob(f"{folder}/part-*.avro"))))
    return spark.createDataFrame(out, "least long, code long, files long")


def export_metrics(spark, sf_dir):
    """The metrics file of an export of several tasks against its files."""
    register(spark, sf_dir, TABLES)
    found, folder = exported(spark, table="orders", split_column="o_orderkey", query_parallelism=3)
    files = glob.glob(f"{folder}/part-*.avro")
    saved = [json.loads(read_text(spark, f"{folder}/{n}.json")) for n in ("_METRICS", "_SERVICE_METRICS")]
    same = saved[0] == saved[1] == found and found == metrics.derived({k: v for k, v in found.items() if k != "KbWritePerSec"})
    names = {"recordCount", "bytesWritten", "writeElapsedMs", "executeQueryElapsedMs", "schemaElapsedTimeMs", "KbWritePerSec", "msPerMillionRows"} <= found.keys()
    return spark.createDataFrame([(found["recordCount"], found["bytesWritten"] == sum(map(os.path.getsize, files)), same, names)], "rows long, bytes_equal boolean, same boolean, names boolean")


def replica_lateness(spark, sf_dir):
    """For each day of the table as a partition, whether a replica of a given time is late, and the exit code of the check."""
    days = [str(r[0]) for r in spark.read.parquet(f"{sf_dir}/events.parquet").select(F.to_date("ts").alias("day")).distinct().collect()]
    last = last_replication(spark.sql("SELECT TIMESTAMP'2024-01-15 06:00:00' AS last_replication, 0 AS replication_delay"))
    return spark.createDataFrame([(d, is_late(last, parse_instant(d), parse_period(None)), is_late(last, parse_instant(d), parse_period("PT6H"))) for d in days], "day string, late boolean, late_hours boolean")


def replica_exports(spark, sf_dir):
    """Exit codes of exports behind a replica check."""
    register(spark, sf_dir, TABLES)
    answer = lambda t: spark.sql(f"SELECT CAST({t} AS TIMESTAMP) AS last_replication, 0 AS replication_delay")
    option = lambda: Options(output=folder_for(), table="region", partition="2025-02-28", skip_partition_check=True)
    cases = {"late": answer("'2017-02-01 23:58:57'"), "in time": answer("'2030-02-01 23:58:57'"), "unknown": answer("NULL"), "no answer": answer("NULL").where("false")}
    rows = [(n, _code(lambda a=a: job.replica_export(spark, option(), Session(), a))) for n, a in cases.items()]
    rows += [("no database", _code(lambda: job.replica_export(spark, option(), Session()))), ("other database", _code(lambda: job.check_replica_options(Jdbc("jdbc:mysql://h/db"), option()))), ("right database", _code(lambda: job.check_replica_options(Jdbc("jdbc:postgresql://h/db"), option())))]
    return spark.createDataFrame([(*r, "pg_last_xact_replay_timestamp()" in REPLICATION_SQL) for r in rows], "name string, code long, asks boolean")


def drivers(spark, sf_dir):
    urls = ["jdbc:postgresql://h/db", "jdbc:mysql://h:3306/shop?a=1", "jdbc:mariadb://h/db", "jdbc:h2:mem:test", "jdbc:oracle:thin:@h", "postgresql://h/db"]
    name = lambda u: driver_class(u) if _code(lambda: driver_class(u)) == 0 else None
    return spark.createDataFrame([(u, name(u), _code(lambda u=u: driver_class(u)), catalog_of(u)) for u in urls], "url string, driver string, code long, catalog string")


def connection_options(spark, sf_dir):
    """What Spark's source is told: fetch size, and statements on reading connections only."""
    source = Jdbc("jdbc:mysql://me:pw@h/db?password=x", "app", "secret", 500, ("SET a = 1;", "SET b = 2"))
    rows = [(kind, k, v) for kind, o in (("probe", source.options()), ("read", source.options(True))) for k, v in o.items() if k not in ("url", "password")]
    return spark.createDataFrame([*rows, ("log", "url", redacted(source.url))], "kind string, name string, value string")


def jdbc_pre_commands(spark, sf_dir):
    """A statement before the query makes a table, which a second reading finds."""
    source = derby(spark, sf_dir, "region", spark.read.parquet(f"{sf_dir}/region.parquet"))
    writing = Jdbc(source.url, "app", "app", commands=("CREATE TABLE made (x INT)",))
    before = _code(lambda: (writing.frame(spark, ExportQuery.table("region")), source.frame(spark, ExportQuery.table("made"))))
    n = writing.rows(spark, [ExportQuery.table("region")]).count()
    return spark.createDataFrame([(before, n, _code(lambda: source.frame(spark, ExportQuery.table("made"))))], "before long, n long, after long")


def query_parameters(spark, sf_dir):
    """A user query with parameter markers, exported."""
    register(spark, sf_dir, TABLES)
    folder = folder_for()
    source = Session(parameters={"least": 20, "name": "F%"})
    job.export(spark, Options(output=folder, sql="SELECT n_nationkey, n_name FROM nation WHERE n_nationkey >= :least OR n_name LIKE :name"), source)
    return avro_rows(spark, folder, "n_nationkey int, n_name string")


def split_types(spark, sf_dir):
    """Which columns can be split."""
    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    return spark.createDataFrame([(f.name, _code(lambda f=f: check_split_type(schema, f.name))) for f in schema], "name string, code long")


def postgres_arrays(spark, sf_dir):
    """Item types by PostgreSQL's type names, and the codes of those that are refused."""
    kind = spark.createDataFrame([], "a array<string>").schema["a"].dataType
    of = lambda c, logical: json.dumps(avro_type(kind, logical, mode=ARRAY_MODES[2], name="a", client=c)["items"])
    names = ["_uuid", "_int", "_int4", "_int8", "_varchar", "_text", "_float8", "text"]
    return spark.createDataFrame([(n, of(n, False) if (code := _code(lambda n=n: of(n, False))) == 0 else None, of(n, True) if code == 0 else None, code) for n in names], "name string, items string, logical string, code long")


def password_sources(spark, sf_dir):
    folder = folder_for()
    write_text(spark, f"{folder}/plain", "in file \n")
    write_text(spark, f"{folder}/coded", "YWJj\nZGVm\n")
    service = KmsDecrypter(project="p", location="l", keyring="r", key="k", post=lambda url, body: {"plaintext": base64.b64encode((" " + base64.b64decode(body["ciphertext"]).decode() + "\n").encode()).decode()})
    read = lambda p: read_text(spark, p)
    found = {"encrypted": read_password(read, f"{folder}/coded", f"{folder}/plain", "option", service), "file": read_password(read, None, f"{folder}/plain", "option"), "option": read_password(read, None, None, "option"), "none": read_password(read, None, None, None)}
    return spark.createDataFrame(list(found.items()), "source string, password string")


def job_names(spark, sf_dir):
    cases = [(None, "Some_DB", "some_table"), ("auto", "db", None), ("mine", "db", "t")]
    return spark.createDataFrame([(i, *[x for x in [job.job_name(*c)]]) for i, c in enumerate(cases)], "i long, name string").select("i", F.regexp_replace("name", "[0-9a-f]{8}$", "*").alias("name"))


def time_limit(spark, sf_dir):
    """A job that goes on for hours ends soon after its limit."""
    began = time.time()
    endless = lambda: spark.range(10**6).selectExpr("explode(sequence(0, 1000000)) AS x", "id").where("xxhash64(x, id) = 7").count()
    code = _code(lambda: job.limited(spark, "time-limit", 1.0, endless))
    return spark.createDataFrame([(code, time.time() - began < 60, _code(lambda: job.limited(spark, "no-limit", 60.0, lambda: spark.range(3).count())))], "code long, soon boolean, other long")


def benchmark_runs(spark, sf_dir):
    """Runs of the benchmark: names of the lines of its table, and the rows that each run has exported."""
    register(spark, sf_dir, TABLES)
    rows, text = job.bench(spark, Options(output=folder_for(), table="customer", executions=2))
    lines = [line.split() for line in text.split("\n")[2:]]
    return spark.createDataFrame([(line[0], float(line[1])) for line in lines if line[0] != "stddev"], "line string, record_count double")


def versions(spark, sf_dir):
    """The version is in the options and in the files."""
    from tablelift import __version__

    register(spark, sf_dir, TABLES)
    _, folder = exported(spark, table="region")
    stamp = f"tablelift {__version__}".encode()
    return spark.createDataFrame([(Options(output="/o").version == __version__, all(stamp in open(f, "rb").read(2000) for f in glob.glob(f"{folder}/*.avro")))], "option boolean, files boolean")


OPERATORS = [parse_partitions, period_ends, partition_ages, option_checks, option_defaults, durations, codecs, sql_clean_up, sql_file_export, command_line_codes, side_files, query_files, schema_files, supplied_schemas, min_rows_export, export_metrics, replica_lateness, replica_exports, drivers, connection_options, jdbc_pre_commands, query_parameters, split_types, postgres_arrays, password_sources, job_names, time_limit, benchmark_runs, versions]


def queries():
    return {f.__name__: f for f in OPERATORS}


def _values(columns: str, *rows: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join(f'({r})' for r in rows)}) t({columns})"


QUERY_FILES_SQL = """
WITH b AS (SELECT MIN(l_orderkey) AS mn, MAX(l_orderkey) AS mx FROM lineitem WHERE l_shipdate >= '1995-01-31' AND l_shipdate < '1995-02-28'),
s AS (SELECT mn, mx, GREATEST(CAST(CEIL((mx - mn) / CAST(3 AS DOUBLE)) AS BIGINT), 1) AS bs FROM b)
SELECT i, 'SELECT * FROM lineitem WHERE 1=1 AND l_shipdate >= ''1995-01-31'' AND l_shipdate < ''1995-02-28'' AND l_orderkey >= ' || (mn + i * bs) || ' AND l_orderkey ' || CASE WHEN i = 2 THEN '<= ' || mx ELSE '< ' || (mn + (i + 1) * bs) END AS text
FROM (SELECT mn, mx, bs, UNNEST(range(3)) AS i FROM s)
"""


def oracle_sql():
    day = "SELECT DISTINCT CAST(ts AS DATE) AS d FROM events"
    return {
        "parse_partitions": "SELECT text, CAST(epoch(t) AS BIGINT) AS seconds FROM (VALUES ('2027', TIMESTAMP '2027-01-01'), ('2027-05', TIMESTAMP '2027-05-01'), ('2027-07-31', TIMESTAMP '2027-07-31'), ('2027-07-31T23', TIMESTAMP '2027-07-31 23:00:00'), ('2027-07-31T23:10', TIMESTAMP '2027-07-31 23:10:00'), ('2027-07-31t23:10:05', TIMESTAMP '2027-07-31 23:10:05'), ('2027-07-31T23:10:05+02:00', TIMESTAMP '2027-07-31 21:10:05'), ('2027-02-30', TIMESTAMP '2027-02-28'), ('2027Z', TIMESTAMP '2027-01-01')) v(text, t)",
        "period_ends": "SELECT d AS day, CAST(d + INTERVAL 1 MONTH AS DATE) AS month_end, CAST(epoch(d + INTERVAL 36 HOUR) AS BIGINT) AS hours_end FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)",
        "partition_ages": f"SELECT CAST(d AS VARCHAR) AS day, CAST(CASE WHEN d > TIMESTAMP '2024-01-18 12:00:00' THEN 0 ELSE 43 END AS BIGINT) AS code, CAST(CASE WHEN d > DATE '2024-01-10' THEN 0 ELSE 43 END AS BIGINT) AS least_code FROM ({day})",
        "option_checks": _values("name, code", "'table', 0", "'both', 43", "'neither', 43", "'bad table', 43", "'split alone', 43", "'parallelism 0', 43", "'column alone', 43", "'bad codec', 43", "'bad mode', 49", "'bad period', 49", "'unknown', 43", "'bad time limit', 49", "'no output', 43", "'no address', 43").replace("SELECT *", "SELECT name, CAST(code AS BIGINT) AS code"),
        "option_defaults": _values("name, value", "'avro_codec', 'deflate6'", "'fetch_size', '10000'", "'export_timeout', 'P7D'", "'min_rows', '-1'", "'array_mode', 'typed_first_row'", "'executions', '3'", "'data_only', 'false'", "'skip_partition_check', 'false'", "'nullable_array_items', 'false'", "'use_avro_logical_types', 'false'").replace("SELECT *", "SELECT name, lower(value) AS value"),
        "durations": _values("text, seconds", "'P7D', 604800.0", "'PT1H30M', 5400.0", "'P1DT12H', 129600.0", "'PT0.5S', 0.5").replace("SELECT *", "SELECT text, CAST(seconds AS DOUBLE) AS seconds"),
        "codecs": "SELECT codec, regexp_replace(codec, '[0-9]', '') AS name, CAST(CASE WHEN codec = 'snappy' THEN 0 ELSE CAST(right(codec, 1) AS INTEGER) END AS BIGINT) AS level, CAST((SELECT sum(n_nationkey) FROM nation) AS BIGINT) AS total FROM (VALUES ('snappy'), ('deflate1'), ('deflate9'), ('zstandard1'), ('zstandard9')) v(codec)",
        "sql_clean_up": "SELECT CAST(i AS BIGINT) AS i, t AS tidied, 'SELECT * FROM (' || t || ') as user_sql_query WHERE 1=1 LIMIT 1' AS wrapped FROM (VALUES (0, 'SELECT 1'), (1, 'SELECT 1 ' || chr(10)), (2, 'SELECT 1;'), (3, 'SELECT '';'' AS x'), (4, 'SELECT ''--'' AS x')) v(i, t)",
        "sql_file_export": "SELECT c_custkey, c_mktsegment, CAST(0 AS BIGINT) AS code FROM customer WHERE c_nationkey = 3",
        "command_line_codes": _values("name, code", "'done', 0", "'too few rows', 50", "'no table', 45", "'no file', 41", "'no database', 43", "'not a replica', 43", "'late', 43").replace("SELECT *", "SELECT name, CAST(code AS BIGINT) AS code"),
        "side_files": _values("kind, file", *[f"'whole', '{f}'" for f in ("_AVRO_SCHEMA.avsc", "_METRICS.json", "_SERVICE_METRICS.json", "_queries/query_0.sql", "_queries/query_1.sql", "part-00000-of-00002.avro", "part-00001-of-00002.avro")], "'data', 'part-00000-of-00001.avro'"),
        "query_files": QUERY_FILES_SQL,
        "schema_files": _values("name, kind, \"column\", record, doc", *[f"'{n}', '{k}', '{c}', 'shop.Orders', 'Some orders'" for n, k, c in (("o_orderkey", '["null", "long"]', "o_orderkey"), ("o_orderdate", '["null", {"type": "long", "logicalType": "timestamp-millis"}]', "o_orderdate"), ("order_status", '["null", "string"]', "order status"))]),
        "supplied_schemas": _values("name, code, doc", "'taken', 0, 'supplied'", "'no JSON', 49, 'supplied'", "'no unions', 49, 'supplied'", "'too few fields', 49, 'supplied'", "'no file', 41, 'supplied'").replace("SELECT *", "SELECT name, CAST(code AS BIGINT) AS code, doc"),
        "min_rows_export": "SELECT CAST(least AS BIGINT) AS least, CAST(CASE WHEN n < least THEN 50 ELSE 0 END AS BIGINT) AS code, CAST(1 AS BIGINT) AS files FROM (VALUES (-1), (25), (26)) v(least), (SELECT count(*) AS n FROM nation)",
        "export_metrics": "SELECT count(*) AS rows, true AS bytes_equal, true AS same, true AS names FROM orders",
        "replica_lateness": f"SELECT CAST(d AS VARCHAR) AS day, TIMESTAMP '2024-01-15 06:00:00' < d + INTERVAL 1 DAY AS late, TIMESTAMP '2024-01-15 06:00:00' < d + INTERVAL 6 HOUR AS late_hours FROM ({day})",
        "replica_exports": _values("name, code, asks", "'late', 20, true", "'in time', 0, true", "'unknown', 49, true", "'no answer', 49, true", "'no database', 43, true", "'other database', 43, true", "'right database', 0, true").replace("SELECT *", "SELECT name, CAST(code AS BIGINT) AS code, asks"),
        "drivers": _values("url, driver, code, catalog", "'jdbc:postgresql://h/db', 'org.postgresql.Driver', 0, 'db'", "'jdbc:mysql://h:3306/shop?a=1', 'com.mysql.cj.jdbc.Driver', 0, 'shop'", "'jdbc:mariadb://h/db', 'org.mariadb.jdbc.Driver', 0, 'db'", "'jdbc:h2:mem:test', 'org.h2.Driver', 0, 'test'", "'jdbc:oracle:thin:@h', NULL, 43, '@h'", "'postgresql://h/db', NULL, 43, 'db'").replace("SELECT *", "SELECT url, driver, CAST(code AS BIGINT) AS code, catalog"),
        "connection_options": _values("kind, name, value", *[f"'{k}', '{n}', '{v}'" for k in ("probe", "read") for n, v in (("driver", "com.mysql.cj.jdbc.Driver"), ("user", "app"), ("fetchsize", "500"))], "'read', 'sessionInitStatement', 'SET a = 1; SET b = 2'", "'read', 'allowMultiQueries', 'true'", "'log', 'url', 'jdbc:mysql://h/db?password=***'"),
        "jdbc_pre_commands": "SELECT CAST(45 AS BIGINT) AS before, count(*) AS n, CAST(0 AS BIGINT) AS after FROM region",
        "query_parameters": "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey >= 20 OR n_name LIKE 'F%'",
        "split_types": "SELECT column_name AS name, CAST(CASE WHEN data_type IN ('INTEGER', 'BIGINT') THEN 0 ELSE 43 END AS BIGINT) AS code FROM information_schema.columns WHERE table_name = 'lineitem'",
        "postgres_arrays": _values("name, items, logical, code", "'_uuid', '\"string\"', '{\"type\": \"string\", \"logicalType\": \"uuid\"}', 0", *[f"'{n}', '\"{k}\"', '\"{k}\"', 0" for n, k in (("_int", "int"), ("_int4", "int"), ("_int8", "long"), ("_varchar", "string"), ("_text", "string"))], "'_float8', NULL, NULL, 49", "'text', NULL, NULL, 49").replace("SELECT *", "SELECT name, items, logical, CAST(code AS BIGINT) AS code"),
        "password_sources": "SELECT * FROM (VALUES ('encrypted', 'abcdef'), ('file', 'in file ' || chr(10)), ('option', 'option'), ('none', NULL)) t(source, password)",
        "job_names": _values("i, name", "0, 'tablelift-somedb-sometable-*'", "1, 'tablelift-db-*'", "2, 'mine'").replace("SELECT *", "SELECT CAST(i AS BIGINT) AS i, name"),
        "time_limit": "SELECT CAST(47 AS BIGINT) AS code, true AS soon, CAST(0 AS BIGINT) AS other",
        "benchmark_runs": "SELECT line, CAST(n AS DOUBLE) AS record_count FROM (VALUES ('run_00'), ('run_01'), ('max'), ('mean'), ('min')) v(line), (SELECT count(*) AS n FROM customer)",
        "versions": "SELECT true AS option, true AS files",
    }
