"""Calendar expressions of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week(d: Column) -> Column:
    """ISO week; January days that belong to the old year's last week count as week 1."""
    w = F.weekofyear(d)
    return F.when((F.month(d) == 1) & (w > 5), F.lit(1)).otherwise(w)


def _week_since(d: Column, start: Column) -> Column:
    # Only January rows fold the old year's week to 1, so days such as 31 December can come out below 1.
    january = F.month(d) == 1
    first = F.weekofyear(start)
    return week(d) - F.when(january & (first > 5), F.lit(1)).otherwise(first) + 1


def quarter_start(d: Column) -> Column:
    return F.date_trunc("quarter", d).cast("date")


def week_of_quarter(d: Column) -> Column:
    return _week_since(d, quarter_start(d))


def week_of_month(d: Column) -> Column:
    return _week_since(d, F.trunc(d, "month"))


def month_of_quarter(d: Column) -> Column:
    return F.month(d) - (F.quarter(d) - 1) * 3


def day_of_quarter(d: Column) -> Column:
    return F.datediff(d, quarter_start(d)) + 1


def days_since(d: Column, start: Column) -> Column:
    return F.datediff(d, start)


def months_before(d: Column, r: int) -> Column:
    """First day of the month r months before d's month."""
    return F.add_months(F.trunc(d, "month"), -r)


def end_of_previous_month(d: Column) -> Column:
    return F.date_sub(F.trunc(d, "month"), 1)


def day_number(d: Column) -> Column:
    return F.datediff(d, F.lit("1970-01-01").cast("date"))


def month_number(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def calendar_fields(d: Column, first_day: Column) -> dict[str, Column]:
    """The twelve calendar columns, in order."""
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "week": week(d),
        "wom": week_of_month(d),
        "woq": week_of_quarter(d),
        "moq": month_of_quarter(d),
        "dom": F.dayofmonth(d),
        "doy": F.dayofyear(d),
        "doq": day_of_quarter(d),
        "dow": F.weekday(d),
        "dot": days_since(d, first_day),
    }
