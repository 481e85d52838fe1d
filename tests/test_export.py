import json
import os
from datetime import datetime, timezone

import pytest

from tablelift.errors import FailedValidation, exit_code
from tablelift.operators.periods import PeriodError, check_age, parse_instant, parse_period, partition_bounds
from tablelift.operators.splits import ranges
from tablelift.plans.job import Options, export
from tablelift.plans.query import ExportQuery, tidy
from tablelift.sources.avro import parse_codec


@pytest.mark.parametrize("least,most,p,starts", [(100, 400, 3, [100, 200, 300]), (100, 402, 5, [100, 161, 222, 283, 344]), (1, 2, 5, [1]), (1, 1, 5, [1]), (1, 10, 1, [1]), (0, 14999, 4, [0, 3750, 7500, 11250]), (0, 10, 6, [0, 2, 4, 6, 8])])
def test_ranges(least, most, p, starts):
    found = ranges(least, most, p)
    assert [r.start for r in found] == starts
    assert found[-1].end == most and not found[-1].open_end


def test_partitions():
    at = parse_instant("2027-07-31")
    assert partition_bounds(at, parse_period(None)) == ("2027-07-31", "2027-08-01")
    assert partition_bounds(at, parse_period("P1M")) == ("2027-07-31", "2027-08-31")
    assert partition_bounds(parse_instant("2027-07-31T00"), parse_period("PT1H")) == ("2027-07-31T00:00:00Z", "2027-07-31T01:00:00Z")
    assert parse_instant("2027-02-30") == datetime(2027, 2, 28, tzinfo=timezone.utc)
    assert parse_instant("2027-07-31t23:10:05+02:00").hour == 21
    for bad in ("P1DT1H", "x"):
        with pytest.raises(PeriodError):
            parse_period(bad)
    with pytest.raises(ValueError):
        check_age(at, parse_period(None), datetime(2027, 8, 2, tzinfo=timezone.utc))


def test_text():
    assert ExportQuery.table("coffees").first(7).text() == "SELECT * FROM coffees WHERE 1=1 LIMIT 7"
    assert tidy("a; \n") == "a \n" and tidy("a;;") == "a;"
    for bad in ("a-b", "1a", ""):
        with pytest.raises(ValueError):
            ExportQuery.table(bad)
    assert ExportQuery.sql("SELECT '--' AS x, \"a--b\" /* -- */ FROM t").base.endswith("user_sql_query")
    with pytest.raises(ValueError):
        ExportQuery.sql("SELECT 1 -- one")
    assert ExportQuery.sql("SELECT 1 -- one\n").text().endswith("\n) as user_sql_query WHERE 1=1")
    for bad in ("deflate0", "gzip", "zstandard10"):
        with pytest.raises(ValueError):
            parse_codec(bad)


@pytest.mark.parametrize("codec", ["deflate1", "zstandard1", "snappy"])
def test_export(spark, tmp_path, codec):
    spark.sql("SELECT id AS k, CAST(id AS DECIMAL(12,2)) AS price, IF(id % 2 = 0, NULL, array(id, NULL)) AS xs, TIMESTAMP'2017-02-28 12:02:03' AS t FROM range(100)").createOrReplaceTempView("things")
    out = str(tmp_path / "out")
    got = export(spark, Options(output=out, table="things", split_column="k", query_parallelism=3, avro_codec=codec, nullable_array_items=True))
    assert got["recordCount"] == 100
    names = sorted(os.listdir(out))
    assert {"_AVRO_SCHEMA.avsc", "_METRICS.json", "_SERVICE_METRICS.json", "_queries"} <= set(names)
    assert json.load(open(f"{out}/_AVRO_SCHEMA.avsc"))["fields"][1]["type"] == ["null", "string"]
    jvm = spark.sparkContext._jvm
    seen = []
    for part in names:
        if part.endswith(".avro"):
            reader = jvm.org.apache.avro.file.DataFileReader(jvm.java.io.File(f"{out}/{part}"), jvm.org.apache.avro.generic.GenericDatumReader())
            while reader.hasNext():
                r = reader.next()
                seen.append((r.get("k"), str(r.get("price")), None if r.get("xs") is None else list(r.get("xs")), r.get("t")))
    assert sorted(seen, key=lambda r: r[0]) == [(i, f"{i}.00", None if i % 2 == 0 else [i, None], 1488283323000) for i in range(100)]


def test_min_rows(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("three")
    with pytest.raises(FailedValidation) as e:
        export(spark, Options(output=str(tmp_path / "o"), table="three", min_rows=4, data_only=True))
    assert exit_code(e.value) == 50
    assert any(x.endswith(".avro") for x in os.listdir(tmp_path / "o"))


def test_queries_run(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 35
    assert set(entry.oracle_sql()) <= set(entry.queries())
