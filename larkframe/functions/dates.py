"""Calendar arithmetic that the built-in date functions do not give directly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week(d: Column) -> Column:
    """Week of the year counted from 1 January (not ISO)."""
    return (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("int")


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def first_format(x: Column, formats: list[str]) -> Column:
    """Date by the first format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(f)).cast("date") for f in formats])


def ceiling(d: Column, unit: str) -> Column:
    """Start of the next unit, also for a date that is already at the start of one; weeks start on Sunday."""
    if unit == "week":
        return F.next_day(d, "Sunday")
    step = {"month": 1, "quarter": 3, "year": 12}[unit]
    return F.add_months(F.trunc(d, unit), step)


def floor(d: Column, unit: str) -> Column:
    if unit == "week":
        return F.date_sub(F.next_day(d, "Sunday"), 7)
    return F.trunc(d, unit)


def age(birth: Column, today: Column) -> Column:
    """Whole years between two dates."""
    before = (F.month(today) * 100 + F.dayofmonth(today)) < (F.month(birth) * 100 + F.dayofmonth(birth))
    return F.year(today) - F.year(birth) - before.cast("int")


def next_anniversary(birth: Column, today: Column) -> Column:
    """First anniversary on or after today; 29 February falls on the 28th in other years."""
    this = F.add_months(birth, 12 * (F.year(today) - F.year(birth)))
    following = F.add_months(birth, 12 * (F.year(today) - F.year(birth) + 1))
    return F.when(this >= today, this).otherwise(following)


def add_business_days(d: Column, n: Column) -> Column:
    """The n-th weekday after d; zero days give d itself.

    With the weekday number 1..5 (a weekend counts from its Friday), every five steps pass one weekend.
    """
    wd = F.weekday(d) + 1
    back = F.when(wd == 6, 1).when(wd == 7, 2).otherwise(0)
    place = F.least(wd, F.lit(5))
    days = n + 2 * F.floor((place - 1 + n) / 5) - back
    return F.when(n == 0, d).otherwise(F.date_add(d, days.cast("int")))


def overlaps(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Closed spans overlap, touching included."""
    return (a0 <= b1) & (b0 <= a1)
