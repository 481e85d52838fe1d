"""The options of an export: their defaults, their checks and the command line."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from tablelift import __version__
from tablelift.functions.conversion import check_array_mode
from tablelift.operators.periods import check_age, parse_duration, parse_instant, parse_period
from tablelift.plans.query import ExportQuery
from tablelift.sources.avro import parse_codec


@dataclass(frozen=True)
class Options:
    """Without a connection address the session's tables and views are exported."""

    output: str
    connection_url: str | None = None
    table: str | None = None
    sql: str | None = None
    sql_file: str | None = None
    username: str = "tablelift"
    password: str | None = None
    password_file: str | None = None
    password_file_kms_encrypted: str | None = None
    partition: str | None = None
    partition_column: str | None = None
    partition_period: str | None = None
    min_partition_period: str | None = None
    skip_partition_check: bool = False
    limit: int | None = None
    split_column: str | None = None
    query_parallelism: int | None = None
    fetch_size: int = 10_000
    pre_command: tuple[str, ...] = ()
    avro_codec: str = "deflate6"
    avro_schema_name: str | None = None
    avro_schema_namespace: str = "tablelift_generated"
    avro_doc: str | None = None
    avro_schema_file_path: str | None = None
    use_avro_logical_types: bool = False
    array_mode: str = "typed_first_row"
    nullable_array_items: bool = False
    export_timeout: str = "P7D"
    data_only: bool = False
    min_rows: int = -1
    executions: int = 3
    job_name: str | None = None
    version: str = __version__

    def check(self) -> None:
        if not self.output:
            raise ValueError("an output folder must be given")
        if sum(x is not None for x in (self.table, self.sql, self.sql_file)) != 1:
            raise ValueError("a table or a file with a query must be given, and not both")
        if (self.split_column is None) != (self.query_parallelism is None):
            raise ValueError("the split column and the query parallelism belong together")
        if self.query_parallelism is not None and self.query_parallelism < 1:
            raise ValueError(f"the query parallelism must be a positive number, not {self.query_parallelism}")
        if self.partition_column and not self.partition:
            raise ValueError("a partition column needs a partition")
        parse_codec(self.avro_codec)
        check_array_mode(self.array_mode)
        parse_duration(self.export_timeout)

    @property
    def timeout(self) -> float:
        return parse_duration(self.export_timeout).total_seconds()

    def query(self, now: datetime | None = None, read: Callable[[str], str] | None = None) -> ExportQuery:
        """`read` returns the text of a file."""
        self.check()
        if self.table is not None:
            out = ExportQuery.table(self.table)
        else:
            out = ExportQuery.sql(self.sql if self.sql is not None else read(self.sql_file))
        if self.partition:
            at, period = parse_instant(self.partition), parse_period(self.partition_period)
            if self.partition_column:
                out = out.partition(self.partition_column, at, period)
            elif not self.skip_partition_check:
                least = parse_instant(self.min_partition_period) if self.min_partition_period else None
                check_age(at, period, now or datetime.now(timezone.utc), least)
        return out.first(self.limit)


class _Parser(argparse.ArgumentParser):
    def error(self, message):
        raise ValueError(message)


def _truth(text: str) -> bool:
    if text.lower() not in ("true", "false"):
        raise argparse.ArgumentTypeError(f"true or false, not {text}")
    return text.lower() == "true"


#: The names of the options.
TEXTS = ["connectionUrl", "table", "sqlFile", "username", "password", "passwordFile", "passwordFileKmsEncrypted", "output", "partition", "partitionColumn", "partitionPeriod", "minPartitionPeriod", "splitColumn", "avroCodec", "avroSchemaName", "avroSchemaNamespace", "avroDoc", "avroSchemaFilePath", "arrayMode", "exportTimeout", "jobName"]
NUMBERS = ["limit", "queryParallelism", "fetchSize", "minRows", "executions"]
FLAGS = ["skipPartitionCheck", "useAvroLogicalTypes", "nullableArrayItems", "dataOnly"]
REQUIRED = ["connectionUrl", "output"]


def _field(name: str) -> str:
    return "".join("_" + c.lower() if c.isupper() else c for c in name)


def parse(arguments: list[str]) -> Options:
    """--name=value (or --name value); flags may stand alone. Unknown and missing options are errors."""
    parser = _Parser(prog="tablelift", allow_abbrev=False)
    for name in TEXTS:
        parser.add_argument(f"--{name}", dest=_field(name), required=name in REQUIRED)
    for name in NUMBERS:
        parser.add_argument(f"--{name}", dest=_field(name), type=int)
    for name in FLAGS:
        parser.add_argument(f"--{name}", dest=_field(name), type=_truth, nargs="?", const=True)
    parser.add_argument("--preCommand", dest="pre_command", action="append")
    given = {k: v for k, v in vars(parser.parse_args(arguments)).items() if v is not None}
    if "pre_command" in given:
        given["pre_command"] = tuple(given["pre_command"])
    return Options(**given)
