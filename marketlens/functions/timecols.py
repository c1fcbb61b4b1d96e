"""Time arithmetic on ``timestamp_ntz`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_hours(ts: Column, hours: Column) -> Column:
    """``ts + hours * INTERVAL 1 HOUR``; hours is an integral column."""
    return ts + F.make_dt_interval(hours=hours.cast("int"))


def add_days(ts: Column, days: Column) -> Column:
    """``ts + days * INTERVAL 1 DAY``."""
    return ts + F.make_dt_interval(days=days.cast("int"))


def whole_days(end: Column, start: Column) -> Column:
    """``EXTRACT(DAY FROM end - start)``: whole days, truncated towards zero.

    -2 days 5 hours gives -2.  This is not ``datediff``, which counts date
    boundaries.  NULL when either side is NULL.
    """
    return F.extract(F.lit("DAY"), end - start)


def micros_between(start: Column, end: Column) -> Column:
    """Signed microseconds from start to end (exact, bigint).

    Read off the day-time interval ``end - start``, which for ``timestamp_ntz`` does
    not depend on the session time zone.  (``timestamp_diff`` does: across a
    daylight-saving change of the session zone it is off by the shift.)
    """
    iv = end - start
    minutes = ((F.extract(F.lit("DAY"), iv) * 24 + F.extract(F.lit("HOUR"), iv)) * 60
               + F.extract(F.lit("MINUTE"), iv)).cast("long")
    return minutes * F.lit(60_000_000) + (F.extract(F.lit("SECOND"), iv) * 1_000_000).cast("long")


def month_floor(ts: Column) -> Column:
    """First day of the month as a DATE (``date_trunc('month', ts)::date``)."""
    return F.trunc(ts, "month")
