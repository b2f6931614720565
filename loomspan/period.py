"""Scan periods: inclusive UTC intervals that are built from local dates."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the only time zone that periods may have.
TIMEZONE = "Asia/Shanghai"


@dataclass(frozen=True)
class Period:
    """Both ends belong to the period."""

    local_start: datetime
    local_end: datetime

    @property
    def utc_start(self) -> datetime:
        return self.local_start.astimezone(UTC)

    @property
    def utc_end(self) -> datetime:
        return self.local_end.astimezone(UTC)

    @property
    def start_date(self) -> str:
        return self.local_start.date().isoformat()

    @property
    def end_date(self) -> str:
        return self.local_end.date().isoformat()

    def contains(self, ts: Column) -> Column:
        """Two-valued: null is outside."""
        return within(ts, F.lit(self.utc_start), F.lit(self.utc_end))

    def predates(self, ts: Column) -> Column:
        """Before the start; null is not, and there is no upper bound."""
        return F.coalesce(ts < F.lit(self.utc_start), F.lit(False))


def within(ts: Column, start: Column, end: Column) -> Column:
    return F.coalesce(ts.between(start, end), F.lit(False))


def build_period(days: int, start: date | None = None, end: date | None = None, now: datetime | None = None, timezone: str = TIMEZONE) -> Period:
    """The last `days` local days up to now, or whole local days from start to end."""
    if timezone != TIMEZONE:
        raise ValueError(f"the time zone must be {TIMEZONE}")
    if (start is None) != (end is None):
        raise ValueError("give both dates or neither")
    zone = ZoneInfo(timezone)
    if start is not None:
        if start > end:
            raise ValueError("the start date is after the end date")
        return Period(datetime.combine(start, time.min, zone), datetime.combine(end, time.max, zone))
    if days < 1:
        raise ValueError("days must be at least 1")
    now = now or datetime.now(UTC)
    if now.tzinfo is None:
        raise ValueError("now needs a time zone")
    local = now.astimezone(zone)
    return Period(datetime.combine(local.date() - timedelta(days=days - 1), time.min, zone), local)
