"""Calendars, guarded parsing and reporting windows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark day-of-week numbers.
DAY_NUMBER = {"SUN": 1, "MON": 2, "TUE": 3, "WED": 4, "THU": 5, "FRI": 6, "SAT": 7}


def week_ending(d: Column, day: str = "THU") -> Column:
    """Date of the next ``day`` on or after ``d``."""
    return F.date_add(d, F.pmod(F.lit(DAY_NUMBER[day]) - F.dayofweek(d), F.lit(7)))


def week_ending_strict(d: Column, day: str = "SUN") -> Column:
    """Date of the next ``day`` strictly after ``d`` (a Sunday rolls to the next week)."""
    return F.next_day(d, day)


def week_start(d: Column, day: str = "MON") -> Column:
    """Date of the last ``day`` on or before ``d``."""
    return F.date_sub(d, F.pmod(F.dayofweek(d) - F.lit(DAY_NUMBER[day]), F.lit(7)))


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_end(d: Column) -> Column:
    return F.last_day(d)


def fiscal_year(d: Column, start_month: Column) -> Column:
    return F.year(F.add_months(d, -(start_month - 1)))


def fiscal_period(d: Column, start_month: Column) -> Column:
    return F.month(F.add_months(d, -(start_month - 1)))


def date_parts(d: Column) -> dict[str, Column]:
    """The attributes of a date dimension, by name."""
    dow = F.dayofweek(d)
    return {
        "year": F.year(d),
        "month_num": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "year_month": F.date_format(d, "yyyy-MM"),
        "quarter": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "day_of_week": F.date_format(d, "EEEE"),
        "dow_num": dow,
        "week_ending": week_ending(d),
        "is_weekend": dow.isin(1, 7),
    }


def local_date(epoch_seconds: Column, zone: str) -> Column:
    """Calendar date in ``zone`` of an epoch second (the session runs in UTC)."""
    return F.from_utc_timestamp(F.timestamp_seconds(epoch_seconds), zone).cast("date")


def first_timestamp(c: Column, formats: Iterable[str | None]) -> Column:
    """The first format that parses; ``None`` stands for ISO text. Unparsable text is NULL."""
    tries = [F.try_to_timestamp(c) if f is None else F.try_to_timestamp(c, F.lit(f)) for f in formats]
    return F.coalesce(*tries)


def guarded_date(c: Column, fmt: str, as_of: Column, floor: str = "1900-01-01") -> Column:
    """Parsed date kept only between ``floor`` and ``as_of``."""
    d = F.try_to_timestamp(c, F.lit(fmt)).cast("date")
    return F.when(d.between(F.lit(floor).cast("date"), as_of), d)


@dataclass(frozen=True)
class Window:
    """Inclusive reporting window; both ends are plain dates fixed once on the driver."""

    start: date
    end: date

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"window start {self.start} is after its end {self.end}")

    @property
    def label(self) -> str:
        return f"{self.start.isoformat()}_to_{self.end.isoformat()}"

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    def holds(self, d: Column) -> Column:
        """Range test with date literals, so it reaches the scan as a pushed filter."""
        return d.between(F.lit(self.start), F.lit(self.end))


def last_week_end(as_of: date, weekday: int = 3) -> date:
    """Most recent week-ending day on or before ``as_of`` (Monday 0, Thursday 3)."""
    return as_of - timedelta(days=(as_of.weekday() - weekday) % 7)


def recent_weeks(as_of: date, weeks: int, floor: date | None = None) -> Window:
    """Week-ending dates of the last ``weeks`` weeks, never below ``floor``."""
    end = last_week_end(as_of)
    start = end - timedelta(weeks=weeks - 1)
    if floor is not None and start < floor:
        start = min(floor, end)
    return Window(start, end)


def last_full_week(as_of: date) -> Window:
    """The last complete Friday-to-Thursday week before ``as_of``."""
    back = (as_of.weekday() - 3) % 7 or 7
    end = as_of - timedelta(days=back)
    return Window(end - timedelta(days=6), end)


def trailing_days(as_of: date, days: int) -> Window:
    """The ``days`` days before ``as_of``, ending yesterday."""
    return Window(as_of - timedelta(days=days), as_of - timedelta(days=1))
