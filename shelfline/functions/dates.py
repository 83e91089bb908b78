"""Date windows of a run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Window:
    """An inclusive range of days."""

    first: dt.date
    last: dt.date

    def days(self) -> list[dt.date]:
        return [self.first + dt.timedelta(n) for n in range((self.last - self.first).days + 1)]


def two_days(target: dt.date) -> Window:
    """The target day and the day before it."""
    return Window(target - dt.timedelta(days=1), target)


def month_of(target: dt.date) -> Window:
    """The whole month of ``target``."""
    first = target.replace(day=1)
    return Window(first, (first + dt.timedelta(days=32)).replace(day=1) - dt.timedelta(days=1))


def month_to_date(target: dt.date) -> Window:
    """From the first of the month to ``target``."""
    return Window(target.replace(day=1), target)


def current_month(target: dt.date, today: dt.date) -> Window:
    """From the first of the target month to the end of today's month."""
    return Window(target.replace(day=1), month_of(today).last)


def date_windows(day: Column | str) -> dict[str, Column]:
    """The date keys a run derives from its target day, as columns."""
    d = F.col(day) if isinstance(day, str) else day
    previous = F.last_day(F.add_months(d, -1))
    return {
        "day_before": F.date_sub(d, 1),
        "day_key": F.date_format(d, "yyyyMMdd"),
        "day_before_key": F.date_format(F.date_sub(d, 1), "yyyyMMdd"),
        "month_key": F.date_format(d, "yyyyMM"),
        "month_first": F.trunc(d, "month"),
        "month_last": F.last_day(d),
        "previous_month": F.date_format(previous, "yyyy-MM"),
        "previous_month_key": F.date_format(previous, "yyyyMM"),
    }


def date_list(df: DataFrame, start: str, end: str, name: str = "day_key") -> DataFrame:
    """One row per day of each ``[start, end]`` row, as ``yyyyMMdd`` text."""
    days = df.select("*", F.explode(F.sequence(F.col(start), F.col(end))).alias("_day"))
    return days.withColumn(name, F.date_format("_day", "yyyyMMdd")).drop("_day")
