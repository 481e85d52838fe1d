"""An export query: a base, conditions and a limit; as SQL text and as a DataFrame."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from tablelift.operators.periods import Period, partition_bounds
from tablelift.operators.splits import Range, bounds_of, check_split_type, ranges

TABLE = re.compile(r"[a-zA-Z_][a-zA-Z0-9_.]*", re.ASCII)
#: Literals, quoted names and closed comments of a line: what is left may begin a comment.
_QUOTED = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`|/\*.*?\*/", re.DOTALL)


def tidy(sql: str) -> str:
    """Without the last semicolon; white space after it stays."""
    return re.sub(r";(\s*)$", r"\1", sql, flags=re.ASCII)


def _name(column: str) -> str:
    if not TABLE.fullmatch(column):
        raise ValueError(f"not a column name: {column}")
    return column


@dataclass(frozen=True)
class ExportQuery:
    base: str
    select: str = "*"
    conditions: tuple[str, ...] = ()
    limit: int | None = None
    split_by: str | None = None

    @classmethod
    def table(cls, name: str) -> ExportQuery:
        if not TABLE.fullmatch(name):
            raise ValueError(f"not a table name: {name}; letters, digits, underscores and dots are allowed")
        return cls(name)

    @classmethod
    def sql(cls, text: str) -> ExportQuery:
        clean = tidy(text)
        if "--" in _QUOTED.sub("", clean).rsplit("\n", 1)[-1]:
            raise ValueError("the last line of the query is a comment, which would hide what follows it")
        return cls(f"({clean}) as user_sql_query")

    def where(self, condition: str) -> ExportQuery:
        return replace(self, conditions=(*self.conditions, condition))

    def partition(self, column: str, at, period: Period) -> ExportQuery:
        start, end = partition_bounds(at, period)
        return self.where(f"{_name(column)} >= '{start}' AND {column} < '{end}'")

    def split(self, column: str, part: Range) -> ExportQuery:
        return replace(self, split_by=part.condition(_name(column)))

    def first(self, n: int | None) -> ExportQuery:
        if n is not None and n < 0:
            raise ValueError("limit must not be negative")
        return replace(self, limit=n)

    def bounds(self, column: str) -> ExportQuery:
        """The query for the ends of a column. Its limit is one of the single row of the result."""
        return replace(self, select=f"MIN({_name(column)}) as min_s, MAX({column}) as max_s")

    def text(self, limit: str = "LIMIT {n}") -> str:
        """Partition first, then split, then limit."""
        conditions = "".join(f" AND {c}" for c in (*self.conditions, *([self.split_by] if self.split_by else [])))
        return f"SELECT {self.select} FROM {self.base} WHERE 1=1{conditions}" + (f" {limit.format(n=self.limit)}" if self.limit is not None else "")

    def frame(self, spark: SparkSession) -> DataFrame:
        """Catalyst pushes the conditions to the scan."""
        return spark.sql(self.text())

    def splits(self, spark: SparkSession, column: str, parallelism: int, source=None) -> list[ExportQuery]:
        """A query for each range; the limit is dealt out by the parallelism asked for.

        `source` answers frame() and bounds_row(); without one, the session's views do."""
        if parallelism < 1:
            raise ValueError("queryParallelism must be greater than 0")
        share = self.first(None if self.limit is None else self.limit // parallelism)
        whole = source.frame(spark, share) if source else ExportQuery(self.base).frame(spark)
        check_split_type(whole.schema, column)
        row = source.bounds_row(spark, share, column) if source else share.bounds(column).frame(spark).head()
        if row is None:
            raise RuntimeError("no row with the ends of the split column: the limit of a split is 0")
        return [share.split(column, r) for r in ranges(*bounds_of(row), parallelism)]


def union(spark: SparkSession, queries: list[ExportQuery]) -> DataFrame:
    """All splits as one DataFrame, without an exchange."""
    frames = [q.frame(spark) for q in queries]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def register(spark: SparkSession, sf_dir: str, tables: list[str]) -> None:
    for t in tables:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
