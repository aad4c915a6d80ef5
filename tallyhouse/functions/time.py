"""Windows, date parts and distances between timestamps.

All of it is arithmetic on timestamps without zone, so results do not depend on the session's zone.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal, so that comparisons reach the parquet reader as pushed filters."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


@dataclass(frozen=True)
class Span:
    """Half-open range [start, end)."""

    start: datetime
    end: datetime

    @property
    def length(self) -> timedelta:
        return self.end - self.start

    def covers(self, at: datetime) -> bool:
        return self.start <= at < self.end

    def holds(self, column: Column) -> Column:
        """The range as a filter."""
        return (column >= moment(self.start)) & (column < moment(self.end))

    def chunks(self, days: int) -> list[Span]:
        """Consecutive pieces of ``days`` days; the last may be shorter."""
        if days < 1:
            raise ValueError("days must be positive")
        step = timedelta(days=days)
        count = -(-(self.end - self.start) // step) if self.end > self.start else 0
        return [Span(self.start + i * step, min(self.start + (i + 1) * step, self.end)) for i in range(count)]


def day_before(as_of: datetime) -> Span:
    """The last full day before ``as_of``."""
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return Span(midnight - timedelta(days=1), midnight)


def hour_before(as_of: datetime) -> Span:
    """The last full hour before ``as_of``."""
    full = as_of.replace(minute=0, second=0, microsecond=0)
    return Span(full - timedelta(hours=1), full)


def day(column: Column) -> Column:
    return F.to_date(column)


def month(column: Column) -> Column:
    """First day of the month, as a date: no time zone involved."""
    return F.trunc(F.to_date(column), "MM")


def whole_days(end: Column, start: Column) -> Column:
    """Whole days of the interval between two timestamps, cut towards zero."""
    return F.extract(F.lit("DAY"), end - start).cast("long")


def calendar_days(end: Column, start: Column) -> Column:
    """Number of midnights between two timestamps."""
    return F.date_diff(F.to_date(end), F.to_date(start))


def _floor_days(interval: Column) -> Column:
    """Whole days of an interval, rounded down."""
    days = F.extract(F.lit("DAY"), interval)
    return F.when(F.make_dt_interval(days=days) > interval, days - 1).otherwise(days)


def days_since(column: Column, as_of: datetime) -> Column:
    """Whole days up to ``as_of``, rounded down also for later timestamps."""
    return _floor_days(moment(as_of) - column).cast("long")


def millis_between(start: Column, end: Column) -> Column:
    """Milliseconds from start to end, cut to an integer; NULL when either end is missing."""
    def part(name: str) -> Column:
        return F.extract(F.lit(name), end - start)

    minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000 + (part("SECOND") * 1000).cast("long")


def chunk_number(column: Column, start: datetime, days: int) -> Column:
    """Index of the ``days``-long piece a timestamp falls in, counted from ``start``."""
    passed = _floor_days(column - moment(start))
    return ((passed - F.pmod(passed, F.lit(days))) / days).cast("int")
