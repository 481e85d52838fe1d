"""Range splits of an integer column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType


@dataclass(frozen=True)
class Range:
    start: int
    end: int
    open_end: bool

    def condition(self, column: str) -> str:
        return f"{column} >= {self.start} AND {column} {'<' if self.open_end else '<='} {self.end}"


def ranges(least: int, most: int, parallelism: int) -> list[Range]:
    """Equal widths, rounded up; the last range is closed. There may be fewer than asked for."""
    if parallelism < 1:
        raise ValueError("queryParallelism must be greater than 0")
    width = max(1, -((least - most) // parallelism))
    starts = range(least, most, width) or [least]
    return [Range(s, most if s == starts[-1] else s + width, s != starts[-1]) for s in starts]


def check_split_type(schema: StructType, column: str) -> None:
    """Splits are of INTEGER and BIGINT columns only."""
    field = {f.name.lower(): f for f in schema}.get(column.rsplit(".", 1)[-1].lower())
    if field is None or not isinstance(field.dataType, (IntegerType, LongType)):
        raise ValueError(f"the split column must be an integer or a long: {column}")


def bounds_of(row) -> tuple[int, int]:
    """min_s and max_s of a row; nulls, those of an empty input too, count as 0."""
    values = {k.lower(): v for k, v in row.asDict().items()}
    return values["min_s"] or 0, values["max_s"] or 0


def bounds(rows: DataFrame, column: str) -> tuple[int, int]:
    """Least and largest value; nulls and empty inputs count as 0."""
    check_split_type(rows.schema, column)
    return bounds_of(rows.agg(F.min(column).alias("min_s"), F.max(column).alias("max_s")).head())
