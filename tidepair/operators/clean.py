"""Clean a panel of daily series.

A panel has the columns ``series``, ``date`` and ``value`` and may hold several
rows per series and day.  Cleaning keeps one row per series and weekday of the
calendar, bridges short gaps with the last observed value, and leaves out every
series that still has a day without a value.

Two shuffles, in an order that stands up to a hot series: rows are first
combined per (series, date), with a partial aggregate on the map side, so one
series with a third of all rows arrives as at most one row per day and map
task, spread over all reducers.  Only then are rows brought together by series,
when each series has no more rows than the calendar has days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepair.functions.calendar import WeekdayCalendar, previous_weekday


def weekday_range(panel: DataFrame, calendar: WeekdayCalendar) -> DataFrame:
    """Rows on a weekday of the calendar, without null names."""
    return panel.where(F.col("series").isNotNull() & calendar.contains(F.col("date")))


def dedup_series(panel: DataFrame, tie: str | None = None) -> DataFrame:
    """One row per series and day: the one with the lowest ``tie``.

    Without a tie column the lowest value is kept.  ``tie`` should be a
    non-null number, unique within series and day; both forms are hash
    aggregates with a map-side partial.
    """
    kept = F.min("value") if tie is None else F.min_by("value", tie)
    return panel.groupBy("series", "date").agg(kept.alias("value"))


def on_calendar(
    panel: DataFrame, calendar: WeekdayCalendar, tie: str | None = None
) -> DataFrame:
    """Filter first (the dates are part of the key, and the filter reaches the
    scan), then deduplicate."""
    return dedup_series(weekday_range(panel, calendar), tie)


def _with_gaps(panel: DataFrame, calendar: WeekdayCalendar) -> DataFrame:
    """Add each row's slot, and the slots around it that it stands for.

    ``from_slot`` is the row's own slot, or 0 on the first row of a series;
    ``next_slot`` is the slot of the next row or the calendar's end.  So the
    ranges [from_slot, next_slot) of a series cover the calendar once.
    """
    by_slot = Window.partitionBy("series").orderBy("slot")
    return (
        panel.withColumn("slot", calendar.slot(F.col("date")))
        .withColumn("_prev", F.lag("slot").over(by_slot))
        .withColumn("next_slot", F.coalesce(F.lead("slot").over(by_slot), F.lit(calendar.size)))
        .withColumn("from_slot", F.when(F.col("_prev").isNull(), 0).otherwise(F.col("slot")))
        .drop("_prev")
    )


def calendar_grid(panel: DataFrame, calendar: WeekdayCalendar) -> DataFrame:
    """Every series of the panel on every day of the calendar."""
    names = panel.select("series").where("series IS NOT NULL").distinct()
    slots = F.sequence(F.lit(0), F.lit(calendar.size - 1))
    return names.withColumn("slot", F.explode(slots)).select(
        "series", calendar.date_at(F.col("slot")).alias("date")
    )


def _own_slots() -> Column:
    """The slots from a row to the next one.  Of rows that share a day, none has a
    slot but the last: a sequence would count downwards from there."""
    upto = F.col("next_slot") - 1
    return F.when(F.col("from_slot") <= upto, F.sequence("from_slot", upto))


def missing_slots(panel: DataFrame, calendar: WeekdayCalendar) -> DataFrame:
    """Days of the calendar on which a series of the panel has no row."""
    return (
        _with_gaps(panel, calendar)
        .select(
            "series",
            "slot",
            F.explode(_own_slots()).alias("at"),
        )
        .where("at <> slot")
        .select("series", calendar.date_at(F.col("at")).alias("date"))
    )


def fill_gaps(panel: DataFrame, calendar: WeekdayCalendar, max_gap: int = 1) -> DataFrame:
    """The full grid of a deduplicated panel.

    A slot without a row takes the last observed value if that lies at most
    ``max_gap`` weekdays back, else null.  Observed nulls are carried, not
    skipped.  ``filled`` marks slots without a row of their own.
    """
    at = F.col("at")
    return (
        _with_gaps(panel, calendar)
        .withColumn("at", F.explode(_own_slots()))
        .select(
            "series",
            calendar.date_at(at).alias("date"),
            F.when(at.between(F.col("slot"), F.col("slot") + max_gap), F.col("value")).alias("value"),
            (at != F.col("slot")).alias("filled"),
        )
    )


def incomplete_series(grid: DataFrame) -> DataFrame:
    """Names with at least one day without a value."""
    return grid.where("value IS NULL").select("series").distinct()


def complete_series(grid: DataFrame) -> DataFrame:
    """Rows of the series that have a value on every day of the grid."""
    per_series = Window.partitionBy("series")
    return (
        grid.withColumn("_hole", F.max(F.col("value").isNull()).over(per_series))
        .where("NOT _hole")
        .drop("_hole")
    )


def clean_series(
    panel: DataFrame,
    calendar: WeekdayCalendar,
    max_gap: int = 1,
    tie: str | None = None,
) -> DataFrame:
    """(series, date, value) with exactly one value per series and slot.

    Whether a series is complete is known from its observed rows alone, so bad
    series are left out before any gap is expanded.
    """
    slot, next_slot = F.col("slot"), F.col("next_slot")
    hole = (
        (F.col("from_slot") < slot)
        | (next_slot - slot - 1 > max_gap)
        | F.col("value").isNull()
    )
    return (
        _with_gaps(on_calendar(panel, calendar, tie), calendar)
        .withColumn("_hole", F.max(hole).over(Window.partitionBy("series")))
        .where("NOT _hole")
        .select("series", "value", F.explode(F.sequence(slot, next_slot - 1)).alias("at"))
        .select("series", calendar.date_at(F.col("at")).alias("date"), "value")
    )


def clean_series_relational(
    panel: DataFrame,
    calendar: WeekdayCalendar,
    max_gap: int = 1,
    tie: str | None = None,
) -> DataFrame:
    """The same result by set operations and joins: grid, minus what is there,
    joined to the previous weekdays, added back, minus incomplete series.

    Kept as an independent second form; :func:`clean_series` shuffles less.
    """
    present = on_calendar(panel, calendar, tie)
    absent = calendar_grid(present, calendar).join(present, ["series", "date"], "left_anti")
    found, back = absent, F.col("date")
    for step in range(1, max_gap + 1):
        back = previous_weekday(back)
        earlier = present.select(
            "series",
            F.col("date").alias("_back"),
            F.struct(F.col("value")).alias(f"_seen{step}"),
        )
        found = found.withColumn("_back", back).join(earlier, ["series", "_back"], "left").drop("_back")
    steps = [F.col(f"_seen{step}") for step in range(1, max_gap + 1)]
    seen = F.coalesce(*steps) if steps else F.struct(F.lit(None).cast("double").alias("value"))
    filled = found.select("series", "date", seen["value"].alias("value"))
    every = present.unionByName(filled)
    return every.join(incomplete_series(every), "series", "left_anti")
