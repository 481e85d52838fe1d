"""Validation: freshness of a replica and the least number of rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.errors import FailedValidation, NotReady
from tablelift.operators.periods import Period

#: Fixed value: what a PostgreSQL replica is asked; the delay is in milliseconds and only told.
REPLICATION_SQL = "SELECT now() AS current_timestamp, pg_last_xact_replay_timestamp() AS last_replication, ROUND((EXTRACT(EPOCH FROM now()) - EXTRACT(EPOCH FROM pg_last_xact_replay_timestamp())) * 1000) AS replication_delay"


def is_late(last: datetime, partition: datetime, period: Period) -> bool:
    return last < period.after(partition)


def check_replica(last: datetime, partition: datetime, period: Period) -> None:
    if is_late(last, partition, period):
        raise NotReady(f"replication is at {last}, the partition ends at {period.after(partition)}")


def fresh_enough(last: Column, partition: Column, period: Period) -> Column:
    """The same of columns (times without zone): not late."""
    if period.seconds is not None:
        return last >= partition + F.make_dt_interval(secs=F.lit(period.seconds))
    return last >= F.expr("timestamp_ntz'1970-01-01'") + (F.add_months(partition.cast("date"), period.months) - F.lit("1970-01-01").cast("date")) + F.make_dt_interval(F.lit(period.days)) + (partition - F.date_trunc("day", partition).cast("timestamp_ntz"))


def last_replication(rows: DataFrame) -> datetime:
    """The one row's last_replication, in UTC."""
    found = rows.head()
    if found is None:
        raise RuntimeError("the replication query has no row; run the export without the check")
    values = {k.lower(): v for k, v in found.asDict().items()}
    if values.get("last_replication") is None:
        raise RuntimeError("last_replication is null; run the export without the check")
    at = values["last_replication"]
    return at.astimezone(timezone.utc) if at.tzinfo else at.replace(tzinfo=timezone.utc)


def check_rows(count: int, least: int) -> None:
    if not enough(count, least):
        raise FailedValidation(f"too few rows: expected at least {least}, got {count}")


def enough(count, least):
    """Of numbers or of columns."""
    return count >= least
