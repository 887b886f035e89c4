from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidepair.functions.calendar import DEFAULT_CALENDAR, WeekdayCalendar, previous_weekday


def weekdays(start: date, end: date) -> list[date]:
    days = (start + timedelta(days=i) for i in range((end - start).days + 1))
    return [d for d in days if d.weekday() < 5]


def test_default_calendar_has_1305_days():
    assert DEFAULT_CALENDAR.size == 1305


@pytest.mark.parametrize("shift", range(7))
@pytest.mark.parametrize("length", [0, 1, 4, 6, 23])
def test_size(shift, length):
    start = date(2024, 1, 1) + timedelta(days=shift)
    end = start + timedelta(days=length)
    assert WeekdayCalendar(start, end).size == len(weekdays(start, end))


@pytest.mark.parametrize("shift", range(7))
def test_slots_and_dates(spark, shift):
    start = date(2024, 1, 1) + timedelta(days=shift)
    end = start + timedelta(days=37)
    calendar = WeekdayCalendar(start, end)
    expected = weekdays(start, end)
    got = calendar.dates(spark).select("date", calendar.slot(F.col("date")).alias("slot"))
    assert sorted((r.slot, r.date) for r in got.collect()) == list(enumerate(expected))
    around = [(start + timedelta(days=i),) for i in range(-9, 50)]
    kept = spark.createDataFrame(around, "date date").where(calendar.contains(F.col("date")))
    assert sorted(r.date for r in kept.collect()) == expected


def test_previous_weekday(spark):
    days = weekdays(date(2024, 1, 1), date(2024, 1, 31))
    rows = spark.createDataFrame([(d,) for d in days], "date date")
    got = {r.date: r.back for r in rows.withColumn("back", previous_weekday(F.col("date"))).collect()}
    assert all(got[b] == a for a, b in zip(days, days[1:]))
    assert got[date(2024, 1, 1)] == date(2023, 12, 29)


def test_day_index_counts_weekends(spark):
    calendar = WeekdayCalendar(date(2024, 1, 1), date(2024, 1, 31))
    row = spark.createDataFrame([(date(2024, 1, 8),)], "date date")
    assert row.select(calendar.day_index(F.col("date")).alias("i")).first().i == 7
