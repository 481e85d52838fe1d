"""Queries of a database on a cluster, whose executors are processes of their own."""

import os
import subprocess
import sys

import pytest
from conftest import ROOT

RUN = """
import sys, duckdb
from pyspark.sql import SparkSession
import __spark_entry__
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", "file://" + sys.argv[1] + "/shared").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
sf, db = "/root/testdata/sf0.001", duckdb.connect()
for t in ("customer", "orders", "region"):
    db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
for name in ("jdbc_scan", "jdbc_split_scan", "jdbc_export", "jdbc_pre_commands"):
    got = __spark_entry__.queries()[name](spark, sf)
    want = db.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(map(repr, map(tuple, got.select(*names).collect()))) == sorted(map(repr, want.fetchall())), name
rows = spark.sql("SELECT CAST(id AS INT) AS k, IF(id % 7 = 0, NULL, id * 10000000000) AS n, CAST(id AS DECIMAL(21,2)) / 4 AS price, IF(id % 5 = 0, NULL, CONCAT('é ', id)) AS name, id / 3 AS x, id % 2 = 0 AS even, CAST(CONCAT('b', id) AS BINARY) AS raw, DATE'2017-02-28' AS day, TIMESTAMP'2017-02-28 12:02:03.456789' AS at FROM range(2500)")
from tablelift.plans import workload
from tablelift.plans.query import ExportQuery
source = workload.derby(spark, sf, "odd", rows)
back = source.rows(spark, [ExportQuery.table("odd")])
plain = lambda f: sorted(repr((r.k, r.n, round(float(r.price), 2), r.name, r.x, r.even, bytes(r.raw), r.day, r.at)) for r in f.collect())
assert plain(back.toDF(*[c.lower() for c in back.columns])) == plain(rows)
import socket
port = int(source.url.split("/")[2].split(":")[1])
with socket.create_connection(("127.0.0.1", port)) as s:  # without the name of the database
    s.sendall(b"\\x00\\x01x")
    assert s.recv(1) == b""
print("ALL SAME")
spark.stop()
"""


def test_database_queries_on_a_cluster(tmp_path):
    env = os.environ | {"PYTHONPATH": ROOT, "SPARK_WORKER_DIR": str(tmp_path / "work"), "SPARK_LOCAL_DIRS": str(tmp_path / "local")}
    run = subprocess.run([sys.executable, "-c", RUN, str(tmp_path)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=600)
    if run.returncode:
        pytest.fail(run.stdout[-2000:] + run.stderr[-4000:])
    assert "ALL SAME" in run.stdout
