"""Date functions (X1-X3) and parsing of date and period literals.

Literal parsing happens on the driver, on the *arguments* of an operator
(strings such as ``"1997-03"`` or ``"90 days"``), so that the resulting
bounds are plain date literals Catalyst can push into the parquet scan.
"""

from __future__ import annotations

import calendar
import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType


def parse_ymd(col: Column | str) -> Column:
    """``yyyymmdd`` number or string to DATE; impossible dates become NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def as_date(col: Column | str, data_type=None) -> Column:
    """Bring a date-like column to DATE: timestamps are cast, text/numbers parsed as yyyymmdd."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(data_type, DateType):
        return c
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return c.cast("date")
    if data_type is None or isinstance(data_type, StringType):
        # ISO text first, then the compact yyyymmdd form
        return F.coalesce(F.try_to_date(c.cast("string")), parse_ymd(c))
    return parse_ymd(c)


def days_between(later: Column, earlier: Column) -> Column:
    """Difference in days as DOUBLE."""
    return F.datediff(later, earlier).cast("double")


_UNITS = ("day", "week", "month", "quarter", "year")


def period_start(col: Column | str, unit: str) -> Column:
    """Floor a date to the start of its calendar period.

    Weeks start on Sunday, the default of the date library the reference uses.
    """
    c = F.col(col) if isinstance(col, str) else col
    unit = unit.lower().rstrip("s")
    if unit == "day":
        return c.cast("date")
    if unit == "week":
        return F.date_sub(c.cast("date"), F.dayofweek(c) - 1)
    if unit in ("month", "quarter", "year"):
        return F.trunc(c.cast("date"), unit)
    raise ValueError(f"unknown period unit {unit!r}; use one of {_UNITS}")


# --- literals -------------------------------------------------------------

_PARTIAL = re.compile(r"^\s*(\d{4})(?:-(\d{1,2}))?(?:-(\d{1,2}))?\s*$")


def expand_partial_date(text: str | _dt.date, side: str) -> _dt.date:
    """``"1997"``, ``"1997-03"`` or ``"1997-03-15"`` to the first (side="start")
    or last (side="end") day it covers; both bounds are inclusive (§1.4-3)."""
    if isinstance(text, _dt.datetime):
        return text.date()
    if isinstance(text, _dt.date):
        return text
    m = _PARTIAL.match(str(text))
    if not m:
        raise ValueError(f"not a (partial) date: {text!r}")
    year, month, day = int(m.group(1)), m.group(2), m.group(3)
    if side not in ("start", "end"):
        raise ValueError("side must be 'start' or 'end'")
    if month is None:
        return _dt.date(year, 1, 1) if side == "start" else _dt.date(year, 12, 31)
    month = int(month)
    if day is None:
        last = calendar.monthrange(year, month)[1]
        return _dt.date(year, month, 1 if side == "start" else last)
    return _dt.date(year, month, int(day))


@dataclass(frozen=True)
class Period:
    """A length of calendar time such as ``"90 days"`` or ``"3 months"``."""

    n: int
    unit: str  # day, week, month, quarter, year

    def subtract_from(self, date: Column) -> Column:
        if self.unit == "day":
            return F.date_sub(date, self.n)
        if self.unit == "week":
            return F.date_sub(date, 7 * self.n)
        months = {"month": 1, "quarter": 3, "year": 12}[self.unit] * self.n
        return F.add_months(date, -months)


_PHRASE = re.compile(r"^\s*(\d+)\s*([a-zA-Z]+)\s*$")


def parse_period(phrase: str | int) -> Period:
    """``"90 days"`` -> Period(90, "day"); a bare integer means days."""
    if isinstance(phrase, int):
        return Period(phrase, "day")
    m = _PHRASE.match(phrase)
    if not m:
        raise ValueError(f"not a period phrase: {phrase!r}")
    unit = m.group(2).lower().rstrip("s")
    if unit not in _UNITS:
        raise ValueError(f"unknown period unit in {phrase!r}")
    return Period(int(m.group(1)), unit)
