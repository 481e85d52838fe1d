"""Metrics of an export: counters are summed over tasks, gauges keep their last value, rates are derived."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of the benchmark's table.
BENCH = ["recordCount", "writeElapsedMs", "msPerMillionRows", "bytesWritten", "KbWritePerSec"]


def counters(tasks: Iterable[dict[str, int]]) -> dict[str, int]:
    out: dict[str, int] = {}
    for task in tasks:
        for name, n in task.items():
            out[name] = out.get(name, 0) + n
    return out


def gauges(values: Iterable[tuple[str, float, int]]) -> dict[str, int]:
    """(name, time, value) rows: for each name the value of the latest time, the largest of equally late ones."""
    latest: dict[str, tuple[float, int]] = {}
    for name, at, value in values:
        latest[name] = max(latest.get(name, (at, value)), (at, value))
    return {name: value for name, (_, value) in latest.items()}


def last_values(rows: DataFrame, name: str, at: str, value: str) -> DataFrame:
    """The same of a DataFrame: name and last value."""
    return rows.groupBy(name).agg(F.max_by(value, F.struct(at, value)).alias(value))


def task_gauges(rows: int, ms: int) -> dict[str, int]:
    """Rates of one task; none without rows, and no rows a minute without a time."""
    out = {"msPerMillionRows": 1_000_000 * ms // rows} if rows else {}
    return out | ({"rowsPerMinute": 60_000 * rows // ms} if rows and ms else {})


def derived(metrics: dict[str, int]) -> dict[str, int]:
    """With KbWritePerSec, bytes by milliseconds in integers; -1 without a time."""
    ms = metrics.get("writeElapsedMs", 0)
    return metrics | {"KbWritePerSec": metrics.get("bytesWritten", 0) // ms if ms > 0 else -1}


def summary(runs: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """max_, mean_, min_ and stddev_ (of the population) of each column over runs."""
    aggregates = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("max", F.max), ("mean", F.avg), ("min", F.min), ("stddev", F.stddev_pop))]
    return runs.groupBy(*(by or [])).agg(*aggregates)


def bench_table(runs: DataFrame) -> str:
    """Tab-separated: a line for each run (a row with `run` and the BENCH columns), then four lines of statistics."""
    line = lambda name, cells: "\t".join([f"{name:<8}", *cells])
    out = [line("name", [f"{c:>10}" for c in BENCH])]
    out += [line(f"run_{r['run']:02d}", [f"{r[c] or 0:10d}" for c in BENCH]) for r in runs.orderBy("run").collect()]  # a row for each execution
    stats = summary(runs.na.fill(0), BENCH).head()
    return "\n".join(out + [line(n, [f"{float(stats[f'{n}_{c}'] or 0):10.1f}" for c in BENCH]) for n in ("max", "mean", "min", "stddev")])
