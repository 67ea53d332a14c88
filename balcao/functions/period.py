"""Reporting periods, all relative to an explicit ``as_of`` date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(as_of: Column | dt.date | str) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def period_start(as_of: Column | dt.date | str) -> Column:
    """First day of the month; on the 1st, of the month before."""
    day = as_date(as_of)
    return F.trunc(F.when(F.dayofmonth(day) == 1, F.date_sub(day, 1)).otherwise(day), "month")


def period_end(as_of: Column | dt.date | str) -> Column:
    """The day itself; on the 1st, the last day of the month before."""
    day = as_date(as_of)
    return F.when(F.dayofmonth(day) == 1, F.date_sub(day, 1)).otherwise(day)


def in_period(moment: Column, as_of: dt.date | str) -> Column:
    """Rows of the reporting period, as plain bounds the scan can be pruned by."""
    return (moment >= period_start(as_of)) & (moment < F.date_add(period_end(as_of), 1))


def days_left(as_of: Column | dt.date | str) -> Column:
    """Days to the end of the month, counting today."""
    day = as_date(as_of)
    return F.datediff(F.last_day(day), day) + 1


def next_month_label(as_of: Column | dt.date | str) -> Column:
    return F.date_format(F.add_months(F.trunc(as_date(as_of), "month"), 1), "MM/yyyy")
