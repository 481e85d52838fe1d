"""Options, command line, exit codes, secrets, databases, replica checks, supplied schemas and the benchmark."""

import base64
import json
import os
import struct
import time
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablelift.__main__ import run
from tablelift.errors import FailedValidation, JobFailed, NotReady, SourceError, exit_code
from tablelift.functions import conversion
from tablelift.operators import metrics
from tablelift.operators.freshness import check_replica, is_late, last_replication
from tablelift.operators.periods import PeriodError, parse_duration, parse_instant, parse_period
from tablelift.operators.splits import ranges
from tablelift.plans import job, workload
from tablelift.plans.options import Options, parse
from tablelift.plans.query import ExportQuery
from tablelift.sources import avro, jdbc
from tablelift.sources.secrets import KmsDecrypter, read_password

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def base(spark):
    """An embedded database with a small table."""
    spark.sql("SELECT CAST(id AS INT) AS k, CONCAT('name ', id) AS name, CAST(id AS DECIMAL(21,2)) / 4 AS price, IF(id % 3 = 0, NULL, id * 10000000000) AS total, CAST(id AS FLOAT) AS size, id % 2 = 0 AS even, TIMESTAMP'2017-02-28 12:02:03.456' AS created FROM range(1, 11)").createOrReplaceTempView("coffee_rows")
    return workload.derby(spark, SF, "coffees", spark.table("coffee_rows"))


def rows_of(spark, folder, schema):
    return sorted(tuple(r) for r in avro.avro_rows(spark, str(folder), schema).collect())


def test_defaults():
    o = parse(["--connectionUrl=jdbc:postgresql://h/db", "--output=/o", "--table=t"])
    assert (o.username, o.fetch_size, o.avro_codec, o.export_timeout, o.min_rows, o.array_mode, o.executions) == ("tablelift", 10000, "deflate6", "P7D", -1, "typed_first_row", 3)
    assert o.timeout == 7 * 86400 and not (o.data_only or o.skip_partition_check or o.nullable_array_items or o.use_avro_logical_types)
    o = parse(["--connectionUrl=u", "--output", "/o", "--sqlFile=f", "--dataOnly", "--skipPartitionCheck=true", "--nullableArrayItems=false", "--preCommand=a", "--preCommand=b", "--limit=7"])
    assert o.data_only and o.skip_partition_check and not o.nullable_array_items and o.pre_command == ("a", "b") and o.limit == 7


@pytest.mark.parametrize("arguments", [[], ["--output=/o", "--table=t"], ["--connectionUrl=u", "--table=t"], ["--connectionUrl=u", "--output=/o", "--table=t", "--odd=1"], ["--connectionUrl=u", "--output=/o", "--table=t", "--limit=x"], ["--connectionUrl=u", "--output=/o", "--table=t", "--dataOnly=maybe"]])
def test_unknown_and_missing_options(arguments):
    with pytest.raises(ValueError):
        parse(arguments)
    assert run(arguments) == 43


@pytest.mark.parametrize("change", [{"table": "a-b"}, {"table": "1a"}, {"table": None}, {"sql_file": "f"}, {"output": ""}, {"partition_column": "c"}, {"query_parallelism": 3}, {"split_column": "c"}, {"split_column": "c", "query_parallelism": 0}, {"split_column": "c", "query_parallelism": -5}, {"limit": -1}, {"avro_codec": "deflate7x"}, {"avro_codec": "snappy1"}, {"partition": "2027-07-31"}, {"partition": "2027-07-31", "min_partition_period": "2027-07-31"}])
def test_bad_combinations(change):
    now = datetime(2030, 1, 1, tzinfo=timezone.utc)
    with pytest.raises(ValueError) as e:
        Options(**({"output": "/o", "table": "t"} | change)).query(now)
    assert exit_code(e.value) == 43


def test_partition_options():
    now = datetime(2027, 8, 1, 23, tzinfo=timezone.utc)
    text = lambda **x: Options(output="/o", table="t", **x).query(now).text()
    assert text(partition="2027-07-31") == "SELECT * FROM t WHERE 1=1"
    assert text(partition="2020-07-31", skip_partition_check=True) == "SELECT * FROM t WHERE 1=1"
    assert text(partition="2020-07-31", min_partition_period="2020-07-30") == "SELECT * FROM t WHERE 1=1"
    assert text(partition="2020-07-31", partition_column="c", limit=5) == "SELECT * FROM t WHERE 1=1 AND c >= '2020-07-31' AND c < '2020-08-01' LIMIT 5"
    with pytest.raises(PeriodError) as e:
        text(partition="2027-07-31", partition_period="P1DT1H")
    assert exit_code(e.value) == 49
    with pytest.raises(conversion.UnsupportedType) as e:
        text(array_mode="odd")
    assert exit_code(e.value) == 49


def test_durations():
    assert parse_duration("P7D") == timedelta(days=7) and parse_duration("PT1H30M") == timedelta(minutes=90) and parse_duration("PT0.5S") == timedelta(seconds=0.5)
    for bad in ("P1M", "P", "PT", "7D", "P1DT"):
        with pytest.raises(PeriodError):
            parse_duration(bad)


@settings(deadline=None, max_examples=200)
@given(st.integers(-(10**12), 10**12), st.integers(0, 10**9), st.integers(1, 200))
def test_ranges_cover_without_overlap(least, span, parallelism):
    found = ranges(least, least + span, parallelism)
    assert 1 <= len(found) <= parallelism and found[0].start == least and found[-1].end == least + span
    assert all(a.end == b.start and a.open_end for a, b in zip(found, found[1:], strict=False)) and not found[-1].open_end


def test_exit_codes():
    cases = [(NotReady(), 20), (FileNotFoundError(), 41), (ValueError(), 43), (SourceError(), 45), (JobFailed(), 47), (FailedValidation(), 50), (RuntimeError(), 49), (KeyError(), 49)]
    assert [exit_code(e) for e, _ in cases] == [c for _, c in cases]


def test_password_and_key_service(tmp_path):
    (tmp_path / "plain").write_text("secret \n")
    (tmp_path / "coded").write_text("Y2lw\n aGVy\n")
    read = lambda p: open(p).read()
    asked = []

    def post(url, body):
        asked.append((url, body))
        return {"plaintext": base64.b64encode(b" opened\n").decode()}

    decrypter = KmsDecrypter(project="p", location="global", keyring="r", key="k", post=post)
    files = str(tmp_path / "coded"), str(tmp_path / "plain")
    assert read_password(read, *files, "x", decrypter) == "opened"
    assert asked[0][0].endswith("projects/p/locations/global/keyRings/r/cryptoKeys/k:decrypt") and asked[0][1] == {"ciphertext": "Y2lwaGVy"}
    assert read_password(read, None, files[1], "x") == "secret \n" and read_password(read, None, None, "x") == "x" and read_password(read, None, None, None) is None


def test_job_names():
    assert job.job_name("mine", "a") == "mine"
    for given_name in (None, "auto"):
        assert job.job_name(given_name, "Some_DB", "some_table").startswith("tablelift-somedb-sometable-")
    assert job.job_name(None, "db", None).count("-") == 2


def test_addresses():
    assert jdbc.driver_class("jdbc:postgresql://h/db") == "org.postgresql.Driver" and jdbc.driver_class("jdbc:mysql://h/db") == "com.mysql.cj.jdbc.Driver"
    for bad in ("jdbc:oracle:thin:@h", "postgresql://h/db", "jdbc", "", "odbc:h2:mem"):
        with pytest.raises(ValueError):
            jdbc.driver_class(bad)
    assert jdbc.redacted("jdbc:mysql://me:pw@h/db?user=a&password=b&x=1") == "jdbc:mysql://h/db?user=***&password=***&x=1"
    assert jdbc.catalog_of("jdbc:postgresql://h:5432/shop?ssl=true") == "shop"
    several = jdbc.Jdbc("jdbc:mysql://h/db", commands=("SET a = 1;", "SET b = 2")).options(reading=True)
    assert several["sessionInitStatement"] == "SET a = 1; SET b = 2" and several["allowMultiQueries"] == "true" and several["fetchsize"] == "10000"
    assert "sessionInitStatement" not in jdbc.Jdbc("jdbc:mysql://h/db", commands=("SET a = 1",)).options()


def test_database_export(spark, base, tmp_path):
    options = Options(output=str(tmp_path / "o"), table="coffees", split_column="k", query_parallelism=3, fetch_size=2)
    found = job.export(spark, options, base)
    assert found["recordCount"] == 10 and found["bytesWritten"] == sum(os.path.getsize(tmp_path / "o" / f) for f in os.listdir(tmp_path / "o") if f.endswith(".avro"))
    assert {"executeQueryElapsedMs", "writeElapsedMs", "schemaElapsedTimeMs", "msPerMillionRows", "KbWritePerSec"} <= found.keys()
    got = rows_of(spark, tmp_path / "o", "k int, name string, price string, total long, size float, even boolean, created long")
    assert [r[:2] for r in got] == [(i, f"name {i}") for i in range(1, 11)] and got[6][2].startswith("1.75") and got[2][3] is None and got[0][6] == 1488283323456
    fields = json.load(open(tmp_path / "o/_AVRO_SCHEMA.avsc"))["fields"]
    assert [f["type"][1] for f in fields] == ["int", "string", "string", "long", "float", "boolean", "long"] and fields[2]["columnTypeName"] == "DECIMAL"
    assert sorted(os.listdir(tmp_path / "o/_queries")) == ["query_0.sql", "query_1.sql", "query_2.sql"]
    assert (tmp_path / "o/_queries/query_0.sql").read_text() == "SELECT * FROM coffees WHERE 1=1 AND k >= 1 AND k < 4"
    assert len([f for f in os.listdir(tmp_path / "o") if f.endswith("-of-00003.avro")]) == 3


def test_database_plans_and_limits(spark, base):
    queries = ExportQuery.table("coffees").splits(spark, "k", 3, base)
    rows = base.rows(spark, queries)
    assert rows.rdd.getNumPartitions() == 3 and rows.count() == 10
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    limited = ExportQuery.table("coffees").first(7).splits(spark, "k", 3, base)
    assert [q.limit for q in limited] == [2, 2, 2] and base.rows(spark, limited).count() == 6
    assert base.frame(spark, queries[0]).columns[0].lower() == "k"


def test_pre_commands_run_when_reading_only(spark, base):
    base_rows = base.rows(spark, [ExportQuery.table("coffees")])
    assert base_rows.count() == 10
    writing = jdbc.Jdbc(base.url, "app", "app", commands=("CREATE TABLE made_by_command (x INT)",))
    writing.frame(spark, ExportQuery.table("coffees"))
    with pytest.raises(SourceError) as e:
        base.frame(spark, ExportQuery.table("made_by_command"))
    assert exit_code(e.value) == 45
    assert writing.rows(spark, [ExportQuery.table("coffees")]).count() == 10
    assert base.frame(spark, ExportQuery.table("made_by_command")).columns[0].lower() == "x"


def test_database_errors(spark, base, tmp_path):
    bad = Options(output=str(tmp_path / "o"), table="no_such_table")
    with pytest.raises(SourceError):
        job.export(spark, bad, base)
    with pytest.raises(ValueError):
        ExportQuery.table("coffees").splits(spark, "name", 2, base)


def test_command_line(spark, base, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT k, name FROM coffees WHERE size >= 5;\n")
    common = [f"--connectionUrl={base.url}", "--username=app", "--password=app"]
    assert run(["export", *common, f"--sqlFile={tmp_path}/q.sql", f"--output={tmp_path}/a", "--minRows=6", "--avroCodec=snappy"], spark) == 0
    assert len(rows_of(spark, tmp_path / "a", "k int, name string")) == 6
    assert run([*common, f"--sqlFile={tmp_path}/q.sql", f"--output={tmp_path}/b", "--minRows=7", "--dataOnly"], spark) == 50
    assert sorted(os.listdir(tmp_path / "b")) == ["part-00000-of-00001.avro"]
    assert run([*common, f"--sqlFile={tmp_path}/none.sql", f"--output={tmp_path}/c"], spark) == 41
    assert run([*common, "--table=nothing", f"--output={tmp_path}/d"], spark) == 45
    assert run([*common, "--table=coffees", f"--output={tmp_path}/e", "--arrayMode=odd"], spark) == 49
    assert run(["--connectionUrl=jdbc:oracle:x", "--table=coffees", f"--output={tmp_path}/f"], spark) == 43
    assert run(["odd", *common, "--table=coffees", f"--output={tmp_path}/g"], spark) == 43
    assert run(["replica-export", *common, "--table=coffees", f"--output={tmp_path}/h", "--partition=2027-07-31", "--skipPartitionCheck"], spark) == 43
    assert run([f"--connectionUrl=parquet:{SF}", "--table=nation", f"--output={tmp_path}/i"], spark) == 0
    assert len(rows_of(spark, tmp_path / "i", "a int, b string, c int")) == 25


def test_failures_and_time_limit(spark, tmp_path):
    spark.sql("SELECT id, IF(id = 3, raise_error('no'), 1) AS x FROM range(10)").createOrReplaceTempView("breaks")
    with pytest.raises(JobFailed) as e:
        job.export(spark, Options(output=str(tmp_path / "o"), table="breaks"))
    assert exit_code(e.value) == 47 and not [f for f in os.listdir(tmp_path / "o") if f.endswith(".avro")]
    assert "_AVRO_SCHEMA.avsc" in os.listdir(tmp_path / "o")
    spark.sql("SELECT a.id FROM range(200000) a CROSS JOIN range(200000) b WHERE xxhash64(a.id, b.id) = 7").createOrReplaceTempView("endless")
    began = time.time()
    with pytest.raises(JobFailed) as e:
        job.export(spark, Options(output=str(tmp_path / "p"), table="endless", export_timeout="PT2S"))
    assert "time limit" in str(e.value) and time.time() - began < 60


def test_metrics_files_may_fail(spark, tmp_path, monkeypatch):
    spark.range(3).createOrReplaceTempView("three_rows")

    def refuse(*_):
        raise OSError("disk")

    real = job.save_below
    monkeypatch.setattr(job, "save_below", lambda s, folder, name, text: refuse() if "METRICS" in name else real(s, folder, name, text))
    assert job.export(spark, Options(output=str(tmp_path / "o"), table="three_rows"))["recordCount"] == 3


def test_replica(spark, tmp_path):
    at = parse_instant("2025-02-28")
    last = lambda text: datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
    for text, period, late in [("2025-03-01", None, False), ("2025-03-02", None, False), ("2025-02-28", None, True), ("2025-02-27", None, True), ("2025-02-28T23:59:59", None, True), ("2025-03-27", "P1M", True), ("2025-03-28", "P1M", False), ("2025-02-28T00:59:59", "PT1H", True), ("2025-02-28T01:00:00", "PT1H", False)]:
        assert is_late(last(text), at, parse_period(period)) == late
    with pytest.raises(NotReady):
        check_replica(at, at, parse_period(None))
    spark.sql("SELECT * FROM range(4)").createOrReplaceTempView("replicated")
    answer = lambda t: spark.sql(f"SELECT TIMESTAMP'{t}' AS last_replication, 1 AS replication_delay")
    assert last_replication(answer("2017-02-01 23:58:57")) == last("2017-02-01T23:58:57")
    options = Options(output=str(tmp_path / "o"), table="replicated", partition="2025-02-28", skip_partition_check=True)
    with pytest.raises(NotReady) as e:
        job.replica_export(spark, options, jdbc.Session(), answer("2017-02-01 23:58:57"))
    assert exit_code(e.value) == 20 and not os.path.exists(tmp_path / "o")
    assert job.replica_export(spark, options, jdbc.Session(), answer("2030-02-01 23:58:57"))["recordCount"] == 4
    for empty in (answer("2030-01-01 00:00:00").where("false"), spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS last_replication")):
        with pytest.raises(RuntimeError):
            last_replication(empty)
    postgres = jdbc.Jdbc("jdbc:postgresql://h/db")
    job.check_replica_options(postgres, options)
    for source, o in ((jdbc.Jdbc("jdbc:mysql://h/db"), options), (postgres, Options(output="/o", table="t")), (jdbc.Session(), options)):
        with pytest.raises(ValueError):
            job.check_replica_options(source, o)


def test_benchmark(spark, tmp_path):
    spark.range(1000).createOrReplaceTempView("thousand")
    rows, text = job.bench(spark, Options(output=str(tmp_path / "o"), table="thousand", executions=2, password="hidden"))
    assert sorted(os.listdir(tmp_path / "o")) == ["run_0", "run_1"] and [r.recordCount for r in rows.collect()] == [1000, 1000]
    lines = text.split("\n")
    assert lines[1].split() == ["name", *metrics.BENCH] and [x.split()[0] for x in lines[2:]] == ["run_00", "run_01", "max", "mean", "min", "stddev"] and "hidden" not in text
    assert lines[4].split()[1] == "1000.0" and lines[7].split()[1] == "0.0"


def test_metrics():
    assert metrics.counters([{"a": 1, "b": 2}, {"a": 3}]) == {"a": 4, "b": 2}
    assert metrics.gauges([("g", 1.0, 5), ("g", 3.0, 7), ("g", 2.0, 9), ("h", 1.0, 1)]) == {"g": 7, "h": 1}
    assert metrics.derived({"bytesWritten": 1000, "writeElapsedMs": 3})["KbWritePerSec"] == 333 and metrics.derived({"bytesWritten": 5})["KbWritePerSec"] == -1
    assert metrics.task_gauges(500, 20) == {"msPerMillionRows": 40000, "rowsPerMinute": 1500000} and metrics.task_gauges(0, 5) == {} and metrics.task_gauges(5, 0) == {"msPerMillionRows": 0}


def test_supplied_schema(spark, tmp_path):
    spark.sql("SELECT 1L AS id, 'x' AS name").createOrReplaceTempView("shows")
    generated = conversion.avro_schema(spark.table("shows"), "shows")
    given_schema = {"type": "record", "name": "Show", "namespace": "v2", "doc": "Record", "fields": [{"name": "id", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}], "doc": "Id"}, {"name": "name", "type": ["null", "string"]}]}
    (tmp_path / "s.avsc").write_text(json.dumps(given_schema))
    job.export(spark, Options(output=str(tmp_path / "o"), table="shows", avro_schema_file_path=str(tmp_path / "s.avsc")))
    assert json.load(open(tmp_path / "o/_AVRO_SCHEMA.avsc")) == given_schema
    plain = given_schema | {"fields": [{"name": "id", "type": "long"}, {"name": "name", "type": "string"}]}
    for bad in ("{", "[]", json.dumps(plain), json.dumps(given_schema | {"fields": given_schema["fields"][:1]}), json.dumps(given_schema | {"type": "enum"})):
        with pytest.raises(conversion.SchemaError) as e:
            conversion.supplied_schema(bad, generated)
        assert exit_code(e.value) == 49
    with pytest.raises(OSError):
        job.export(spark, Options(output=str(tmp_path / "p"), table="shows", avro_schema_file_path=str(tmp_path / "none.avsc")))


def test_type_rules(spark):
    from pyspark.sql import types as T

    assert conversion.avro_type(T.StringType(), True, client="uuid") == {"type": "string", "logicalType": "uuid"} and conversion.avro_type(T.StringType(), client="uuid") == "string"
    assert conversion.avro_type(T.BooleanType(), client="bit") == "boolean" and conversion.avro_type(T.LongType(), client="BIT") == "bytes"
    assert conversion.avro_type(T.DateType(), True) == {"type": "long", "logicalType": "timestamp-millis"} and conversion.avro_type(T.DecimalType(10, 2)) == "string"
    strings = T.ArrayType(T.StringType())
    assert conversion.avro_type(strings, mode="bytes") == "bytes"
    assert [conversion.avro_type(strings, mode="typed_postgres", client=c)["items"] for c in ("_varchar", "_text", "_uuid", "_int", "_int4", "_int8")] == ["string", "string", "string", "int", "int", "long"]
    assert conversion.avro_type(strings, True, True, "typed_postgres", client="_uuid") == {"type": "array", "items": [{"type": "string", "logicalType": "uuid"}, "null"]}
    for kind, mode, client in ((strings, "typed_postgres", "text"), (strings, "typed_postgres", "_float8"), (T.ArrayType(strings), "typed_first_row", ""), (T.StructType(), "bytes", ""), (T.MapType(T.StringType(), T.StringType()), "bytes", "")):
        with pytest.raises(conversion.UnsupportedType) as e:
            conversion.avro_type(kind, mode=mode, client=client)
        assert exit_code(e.value) == 49
    for name in ("REF", "DATALINK"):
        with pytest.raises(conversion.UnsupportedType):
            conversion.refuse(name)
    rows = spark.sql("SELECT array('a', 'b c', 'd\"e', '', 'null', NULL) AS xs, array(1.5D, 2D) AS ys, CAST(NULL AS ARRAY<INT>) AS zs, array(true, NULL) AS bs")
    got = conversion.export_columns(rows, mode="bytes").head()
    assert [None if x is None else bytes(x).decode() for x in got] == ['{a,"b c","d\\"e","","null",NULL}', "{1.5,2.0}", None, "{true,NULL}"]
    with pytest.raises(Exception, match="--nullableArrayItems"):
        conversion.export_columns(spark.sql("SELECT array(1, NULL) AS xs")).collect()


def test_times_of_a_database(spark):
    """TIME and DATE of a database are milliseconds of the first day of the epoch, and of midnight."""
    source = workload.derby(spark, SF, "instants", spark.sql("SELECT 1 AS one"))
    rows = source.rows(spark, [ExportQuery.sql("SELECT TIME('01:02:03') AS t, DATE('2017-02-28') AS d FROM instants")])
    assert tuple(conversion.export_columns(rows).head()) == (3723000, 1488240000000)


def _slow(kind, x):
    """A value by the format's definition."""

    def varint(n):
        n, out = (n << 1) ^ (n >> 63), b""
        while n > 0x7F:
            out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
        return out + bytes([n])

    name = kind["type"] if isinstance(kind, dict) else kind
    if name in ("int", "long"):
        return varint(x)
    if name in ("string", "bytes"):
        x = x.encode() if name == "string" else x
        return varint(len(x)) + x
    if name == "boolean":
        return bytes([x])
    if name in ("double", "float"):
        return struct.pack("<d" if name == "double" else "<f", x)
    inner = kind["items"]
    each = [(b"\2" if i is None else b"\0" + _slow(inner[0], i)) if isinstance(inner, list) else _slow(inner, i) for i in x]
    return (varint(len(x)) + b"".join(each) if x else b"") + b"\0"


LONGS = st.integers(-(2**63), 2**63 - 1)
COLUMNS = {
    "long": ("long", pa.int64(), LONGS),
    "int": ("int", pa.int32(), st.integers(-(2**31), 2**31 - 1)),
    "string": ("string", pa.string(), st.text(max_size=200)),
    "bytes": ("bytes", pa.binary(), st.binary(max_size=90)),
    "boolean": ("boolean", pa.bool_(), st.booleans()),
    "double": ("double", pa.float64(), st.floats(allow_nan=False)),
    "float": ("float", pa.float32(), st.floats(width=32, allow_nan=False)),
    "longs": ({"type": "array", "items": "long"}, pa.list_(pa.int64()), st.lists(LONGS, max_size=70)),
    "strings": ({"type": "array", "items": ["string", "null"]}, pa.list_(pa.string()), st.lists(st.none() | st.text(max_size=9), max_size=5)),
}


@settings(deadline=None, max_examples=60)
@given(st.data())
def test_encoder(data):
    names = data.draw(st.lists(st.sampled_from(sorted(COLUMNS)), min_size=1, max_size=4))
    n = data.draw(st.integers(0, 12))
    values = [data.draw(st.lists(st.none() | COLUMNS[c][2], min_size=n, max_size=n)) for c in names]
    columns = [pa.array(v, COLUMNS[c][1]) for c, v in zip(names, values, strict=True)]
    cut = data.draw(st.integers(0, n))
    got, sizes = avro.encode_batch([COLUMNS[c][0] for c in names], [c.slice(cut) for c in columns], n - cut)
    want = [b"".join(b"\0" if x is None else b"\2" + _slow(COLUMNS[c][0], x) for c, x in zip(names, row, strict=True)) for row in zip(*[c.to_pylist() for c in columns], strict=True)][cut:]
    assert got.tobytes() == b"".join(want) and sizes.tolist() == list(map(len, want))


def test_blocks(spark, tmp_path):
    """Rows over many blocks, and an attempt that fails leaves nothing."""
    spark.sql("SELECT id, repeat('x', 1000) AS s FROM range(3000)").createOrReplaceTempView("wide")
    job.export(spark, Options(output=str(tmp_path / "o"), table="wide", avro_codec="deflate1"))
    assert [r[0] for r in rows_of(spark, tmp_path / "o", "id long, s string")] == list(range(3000))
