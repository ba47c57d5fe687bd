"""Dates, times and safe casts (DT1-DT6, CST1, CST2)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from laketide.functions._util import as_col

# Text formats of the original raw files.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_DMY_FORMAT = "dd-MM-yyyy"
DATE_ISO_FORMAT = "yyyy-MM-dd"


def run_date(d) -> _dt.date:
    """Normalise a run date given as date, datetime or ISO text (DT6)."""
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    # strict: trailing text is an error, not cut off
    return _dt.datetime.fromisoformat(str(d).strip()).date()


def to_day(c) -> Column:
    """Calendar date of a timestamp (DT1)."""
    return F.to_date(as_col(c))


def day_text(c) -> Column:
    """ISO text of the calendar date (DT2)."""
    return F.date_format(as_col(c), DATE_ISO_FORMAT)


def days_between(stop, start) -> Column:
    """Calendar days from start to stop (DT3), DATEDIFF semantics."""
    return F.datediff(F.to_date(as_col(stop)), F.to_date(as_col(start)))


def epoch_seconds(c) -> Column:
    """Timestamp -> seconds since the epoch (DT5)."""
    return F.unix_timestamp(as_col(c)).cast("long")


def minutes_between(stop, start) -> Column:
    """Fractional minutes from start to stop (DT4)."""
    return (epoch_seconds(stop) - epoch_seconds(start)) / F.lit(60)


def parse_timestamp(c, fmt: str | None = None) -> Column:
    """Text -> timestamp; malformed text -> NULL, not an error.

    Without a format it accepts ISO forms, with or without ``T`` and ``Z``.
    """
    col = as_col(c)
    if fmt:
        return F.try_to_timestamp(col, F.lit(fmt))
    return F.try_to_timestamp(col)


def parse_date(c, fmt: str = DATE_ISO_FORMAT) -> Column:
    """Text -> date; malformed text -> NULL (CST2)."""
    return F.try_to_date(as_col(c), fmt) if hasattr(F, "try_to_date") else \
        F.to_date(parse_timestamp(c, fmt))


def parse_double(c) -> Column:
    """Text -> double; malformed text -> NULL (CST1)."""
    return as_col(c).try_cast("double")
