"""Calendar-hierarchy partition grouping.

The reference's tables group day partitions hierarchically with
``(date, active_months=3, active_years=2)``: days of recent months stay
as days, older days of recent years collapse to their month, and anything
older collapses to its year.  Our stated boundary rule: the current month
counts as the first active month, and the current year as the first
active year.  The key is a date (day, first of month, or first of year),
usable as a compaction partition key.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_hierarchy_key(day: Column | str, as_of: Column | str,
                           active_months: int = 3, active_years: int = 2) -> Column:
    d = F.col(day) if isinstance(day, str) else day
    now = F.col(as_of) if isinstance(as_of, str) else as_of
    month_start = F.trunc(now, "month")
    year_start = F.trunc(now, "year")
    first_daily = F.add_months(month_start, -(active_months - 1))
    first_monthly = F.add_months(year_start, -12 * (active_years - 1))
    return (F.when(d >= first_daily, d)
            .when(d >= first_monthly, F.trunc(d, "month"))
            .otherwise(F.trunc(d, "year")))


def calendar_hierarchy_sql_duckdb(day: str, as_of: str, active_months: int = 3,
                                  active_years: int = 2) -> str:
    m = f"date_trunc('month', {as_of})"
    y = f"date_trunc('year', {as_of})"
    return (
        f"CAST(CASE WHEN {day} >= {m} - INTERVAL {active_months - 1} MONTH THEN {day} "
        f"WHEN {day} >= {y} - INTERVAL {12 * (active_years - 1)} MONTH THEN date_trunc('month', {day}) "
        f"ELSE date_trunc('year', {day}) END AS DATE)"
    )


def calendar_period(day: _dt.date, as_of: _dt.date, active_months: int = 3, active_years: int = 2) -> tuple[_dt.date, _dt.date]:
    """First and last day of the period that a day is kept in: itself, its month or its year."""
    months = as_of.year * 12 + as_of.month - 1 - (active_months - 1)
    if day >= _dt.date(months // 12, months % 12 + 1, 1):
        return day, day
    if day.year >= as_of.year - (active_years - 1):
        first = day.replace(day=1)
        return first, (first + _dt.timedelta(days=31)).replace(day=1) - _dt.timedelta(days=1)
    return day.replace(month=1, day=1), day.replace(month=12, day=31)
