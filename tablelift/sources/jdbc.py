"""Databases by Spark's JDBC source. The generated text runs in the database: conditions, limits, MIN and MAX."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tablelift.errors import SourceError
from tablelift.plans.query import ExportQuery

#: Databases and their driver classes.
DRIVERS = {"postgresql": "org.postgresql.Driver", "mysql": "com.mysql.cj.jdbc.Driver", "mariadb": "org.mariadb.jdbc.Driver", "h2": "org.h2.Driver"}
#: Databases whose limit is not written LIMIT n; tests and embedders add theirs with add_driver().
LIMITS: dict[str, str] = {}


def add_driver(name: str, driver: str, limit: str = "LIMIT {n}") -> None:
    """Allow one more database: the name in jdbc:<name>:, its driver class and its form of a limit."""
    DRIVERS[name], LIMITS[name] = driver, limit


def database_of(url: str) -> str:
    parts = url.split(":", 2)
    if len(parts) < 3 or parts[0] != "jdbc" or parts[1] not in DRIVERS:
        raise ValueError(f"not a supported JDBC address: {redacted(url)}; it must begin with one of {', '.join(f'jdbc:{k}:' for k in DRIVERS)}")
    return parts[1]


def driver_class(url: str) -> str:
    return DRIVERS[database_of(url)]


def redacted(url: str) -> str:
    """The address without user, password and other secrets, for logs and schemas."""
    url = re.sub(r"//[^/@?;]*@", "//", url)
    return re.sub(r"(?i)([?&;])(user|username|password|sslpassword|[a-z]*secret|[a-z]*token)=[^&;]*", r"\1\2=***", url)


def catalog_of(url: str) -> str:
    """The database's name in the address, for the name of the job."""
    path = re.split(r"[?;]", url.split(":", 2)[-1], maxsplit=1)[0]
    return path.rstrip("/").rsplit("/", 1)[-1].rsplit(":", 1)[-1]


def _java_causes(error: BaseException):
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        yield cause.getClass().getName(), cause.getMessage()
        cause = cause.getCause()


def source_error(error: BaseException) -> BaseException:
    """SourceError if the database refused something, else the error itself."""
    text = str(error)
    names = [n for n, _ in _java_causes(error)]
    if any("SQL" in n.rsplit(".", 1)[-1] and "Exception" in n and not n.startswith("org.apache.spark") for n in names) or re.search(r"java\.sql\.SQL\w*Exception", text):
        return SourceError(text.split("\n", 1)[0])
    return error


@dataclass(frozen=True)
class Jdbc:
    """A database. `commands` run on each reading connection before its query, not for schema or bounds."""

    url: str
    username: str = "tablelift"
    password: str | None = field(default=None, repr=False)
    fetch_size: int = 10_000
    commands: tuple[str, ...] = ()

    @property
    def catalog(self) -> str:
        return catalog_of(self.url)

    def options(self, reading: bool = False) -> dict[str, str]:
        database = database_of(self.url)
        out = {"url": self.url, "driver": DRIVERS[database], "user": self.username, "fetchsize": str(self.fetch_size)}
        if self.password is not None:
            out["password"] = self.password
        if reading and self.commands:
            # one statement text a connection: databases here take several statements in one
            out["sessionInitStatement"] = "; ".join(c.strip().rstrip(";") for c in self.commands)
            if len(self.commands) > 1 and database in ("mysql", "mariadb"):
                out["allowMultiQueries"] = "true"
        return out

    def text(self, query: ExportQuery) -> str:
        return query.text(LIMITS.get(database_of(self.url), "LIMIT {n}"))

    def _load(self, spark: SparkSession, text: str, reading: bool = False) -> DataFrame:
        from py4j.protocol import Py4JJavaError

        try:
            return spark.read.format("jdbc").options(**self.options(reading)).option("dbtable", f"({text}) tablelift_rows").load()
        except (Py4JJavaError, PySparkException) as e:
            raise source_error(e) from e

    def frame(self, spark: SparkSession, query: ExportQuery) -> DataFrame:
        """The query for its schema: of the base with a limit of one row, and no row is read."""
        return self._load(spark, self.text(ExportQuery(query.base).first(1)))

    def bounds_row(self, spark: SparkSession, query: ExportQuery, column: str):
        """MIN and MAX, computed by the database; None if there is no row."""
        from py4j.protocol import Py4JJavaError

        try:
            return self._load(spark, self.text(query.bounds(column))).head()
        except (Py4JJavaError, PySparkException) as e:
            raise source_error(e) from e

    def first_row(self, spark: SparkSession, query: ExportQuery):
        return self._load(spark, self.text(ExportQuery(query.base).first(1))).head()

    def rows(self, spark: SparkSession, queries: list[ExportQuery]) -> DataFrame:
        """A partition and connection for each query. Splits without a limit are one scan with a predicate each."""
        base = replace(queries[0], split_by=None)
        if all(q.split_by and q.limit is None and replace(q, split_by=None) == base for q in queries):
            options = {k: v for k, v in self.options(True).items() if k != "url"}
            return spark.read.jdbc(self.url, f"({self.text(base)}) tablelift_rows", predicates=[q.split_by for q in queries], properties=options)
        return reduce(DataFrame.unionByName, [self._load(spark, self.text(q), reading=True) for q in queries])


@dataclass(frozen=True)
class Session:
    """Tables and views of the Spark session; with a folder, its <name>.parquet files as views first.

    `parameters` are values for the named markers (:name) of a user query."""

    folder: str | None = None
    catalog: str = "session"
    parameters: dict | None = None

    @classmethod
    def of(cls, url: str) -> Session:
        """parquet:<folder>"""
        return cls(url.split(":", 1)[1].rstrip("/"), url.rstrip("/").rsplit("/", 1)[-1])

    def text(self, query: ExportQuery) -> str:
        return query.text()

    def prepare(self, spark: SparkSession) -> None:
        if self.folder is None:
            return
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(self.folder)
        for f in target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target):
            name = f.getPath().getName()
            if name.endswith(".parquet"):
                spark.read.parquet(f"{self.folder}/{name}").createOrReplaceTempView(name.removesuffix(".parquet"))

    def frame(self, spark: SparkSession, query: ExportQuery) -> DataFrame:
        self.prepare(spark)
        try:
            return spark.sql(ExportQuery(query.base).text(), args=self.parameters)
        except PySparkException as e:  # what a database would call an error of the statement
            raise SourceError(str(e).split("\n", 1)[0]) from e

    def bounds_row(self, spark: SparkSession, query: ExportQuery, column: str):
        return spark.sql(self.text(query.bounds(column)), args=self.parameters).head()

    def first_row(self, spark: SparkSession, query: ExportQuery):
        return self.frame(spark, query).limit(1).head()

    def rows(self, spark: SparkSession, queries: list[ExportQuery]) -> DataFrame:
        """All splits as one DataFrame, without an exchange."""
        return reduce(DataFrame.unionByName, [spark.sql(self.text(q), args=self.parameters) for q in queries])


def source_of(url: str, **settings) -> Jdbc | Session:
    if url.startswith("parquet:"):
        return Session.of(url)
    database_of(url)
    return Jdbc(url, **settings)
