"""A Monday-to-Friday calendar as column arithmetic.

A date's position on the calendar ("slot") and the date at a slot are closed
formulas, so no calendar table is joined to the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def is_weekday(day: Column) -> Column:
    """Monday to Friday; ``dayofweek`` counts from Sunday = 1."""
    return F.dayofweek(day).between(2, 6)


def previous_weekday(day: Column) -> Column:
    """The weekday before a weekday: Friday for a Monday, else the day before."""
    return F.date_sub(day, F.when(F.dayofweek(day) == 2, 3).otherwise(1))


@dataclass(frozen=True)
class WeekdayCalendar:
    """All weekdays from ``start`` to ``end``, both included."""

    start: date
    end: date

    @property
    def _monday(self) -> date:
        return self.start - timedelta(days=self.start.weekday())

    @property
    def _skipped(self) -> int:
        # weekdays of the first week that lie before the start
        return min(self.start.weekday(), 5)

    @property
    def size(self) -> int:
        days = (self.end - self._monday).days
        if self.end < self.start:
            return 0
        return days // 7 * 5 + min(days % 7 + 1, 5) - self._skipped

    def contains(self, day: Column) -> Column:
        return day.between(F.lit(self.start), F.lit(self.end)) & is_weekday(day)

    def slot(self, day: Column) -> Column:
        """Position 0 .. size-1 of a weekday of the calendar."""
        days = F.datediff(day, F.lit(self._monday))
        return F.floor(days / 7).cast("int") * 5 + days % 7 - self._skipped

    def date_at(self, slot: Column) -> Column:
        """The date at a slot; inverse of :meth:`slot`."""
        k = slot.cast("int") + self._skipped
        return F.date_add(F.lit(self._monday), F.floor(k / 5).cast("int") * 7 + k % 5)

    def day_index(self, day: Column) -> Column:
        """Days since the start of the calendar, weekends counted."""
        return F.datediff(day, F.lit(self.start))

    def dates(self, spark: SparkSession) -> DataFrame:
        return spark.range(self.size).select(self.date_at(F.col("id")).alias("date"))


# The date range that daily price data is cleaned to by default.
DEFAULT_START = date(2016, 1, 1)
DEFAULT_END = date(2020, 12, 31)
DEFAULT_CALENDAR = WeekdayCalendar(DEFAULT_START, DEFAULT_END)
