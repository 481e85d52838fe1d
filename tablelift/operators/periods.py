"""Partitions: instants, periods and their half-open bounds."""

from __future__ import annotations

import calendar
import re
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

_INSTANT = re.compile(r"(\d{4})(?:-(\d{2})(?:-(\d{2})(?:T(\d{2})(?::(\d{2})(?::(\d{2}))?)?)?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?", re.IGNORECASE | re.ASCII)
_CALENDAR = re.compile(r"P(?=\d)(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?", re.IGNORECASE)
_CLOCK = re.compile(r"P(?:(\d+)D)?T(?=\d)(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?", re.IGNORECASE)

_DURATION = re.compile(r"P(?:(\d+)D)?(?:T(?=\d)(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?", re.IGNORECASE | re.ASCII)


class PeriodError(Exception):
    """A text that is no period; not a ValueError, so that it has the exit code for other errors."""


def parse_instant(text: str) -> datetime:
    """Year, month, day, hour, minute and second, as far as given, with an optional offset; UTC without one."""
    found = _INSTANT.fullmatch(text)
    if not found:
        raise PeriodError(f"not a partition: {text}")
    year, month, day, hour, minute, second = (int(x) if x else d for x, d in zip(found.groups()[:6], (1, 1, 1, 0, 0, 0), strict=True))
    if not 1 <= month <= 12 or not 1 <= day <= 31 or hour > 23 or minute > 59 or second > 59:
        raise PeriodError(f"not a partition: {text}")
    offset = found[7] or "Z"
    shift = timedelta(0)
    if offset.upper() != "Z":
        digits = offset[1:].replace(":", "").ljust(4, "0")
        shift = timedelta(hours=int(digits[:2]), minutes=int(digits[2:])) * (-1 if offset[0] == "-" else 1)
    day = min(day, calendar.monthrange(year, month)[1])
    return datetime(year, month, day, hour, minute, second, tzinfo=timezone.utc) - shift


@dataclass(frozen=True)
class Period:
    months: int = 0
    days: int = 0
    seconds: int | None = None  # a clock period if set

    def after(self, at: datetime) -> datetime:
        if self.seconds is not None:
            return at + timedelta(seconds=self.seconds)
        return _add_months(at, self.months) + timedelta(days=self.days)

    def before(self, at: datetime) -> datetime:
        return Period(-self.months, -self.days, None if self.seconds is None else -self.seconds).after(at)


def _add_months(at: datetime, months: int) -> datetime:
    year, month = divmod(at.year * 12 + at.month - 1 + months, 12)
    return at.replace(year=year, month=month + 1, day=min(at.day, calendar.monthrange(year, month + 1)[1]))


def parse_period(text: str | None) -> Period:
    """A day if none is given; a text with PT is a clock period, any other a calendar period."""
    if text is None:
        return Period(days=1)
    if "PT" in text:
        found = _CLOCK.fullmatch(text)
        if found:
            d, h, m, s = (int(x or 0) for x in found.groups())
            return Period(seconds=((d * 24 + h) * 60 + m) * 60 + s)
    elif found := _CALENDAR.fullmatch(text):
        y, m, w, d = (int(x or 0) for x in found.groups())
        return Period(months=12 * y + m, days=7 * w + d)
    raise PeriodError(f"not a period: {text}")


def parse_duration(text: str) -> timedelta:
    """Days, hours, minutes and seconds: P7D, PT1H30M, P1DT12H, PT0.5S."""
    found = _DURATION.fullmatch(text)
    if not found or not any(found.groups()):
        raise PeriodError(f"not a duration: {text}")
    d, h, m, s = (float(x or 0) for x in found.groups())
    return timedelta(days=d, hours=h, minutes=m, seconds=s)


def partition_bounds(at: datetime, period: Period) -> tuple[str, str]:
    """Start and end as SQL texts: dates for calendar periods, whole instants for clock periods."""
    if period.seconds is None:
        start = at.replace(hour=0, minute=0, second=0)
        return f"{start:%Y-%m-%d}", f"{period.after(start):%Y-%m-%d}"
    return f"{at:%Y-%m-%dT%H:%M:%SZ}", f"{period.after(at):%Y-%m-%dT%H:%M:%SZ}"


def check_age(at: datetime, period: Period, now: datetime, least: datetime | None = None) -> None:
    """The partition must be later than `least`, or than two periods before now."""
    bound = least or period.before(period.before(now))
    if not at > bound:
        raise ValueError(f"partition {at:%Y-%m-%dT%H:%M:%SZ} is too old: it must be later than {bound:%Y-%m-%dT%H:%M:%SZ}, unless --skipPartitionCheck is given")
