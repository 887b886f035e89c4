"""Visits on a calendar, and series as vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepair.functions.calendar import WeekdayCalendar


def sum_visits(visits: DataFrame) -> DataFrame:
    """One row per topic and day; repeated rows are added up."""
    return (
        visits.where("topic IS NOT NULL AND date IS NOT NULL")
        .groupBy("topic", "date")
        .agg(F.sum(F.col("visit").cast("double")).alias("visit"))
    )


def align_to_calendar(df: DataFrame, calendar: WeekdayCalendar) -> DataFrame:
    """Rows on calendar days only, with ``day_index``, the days since its start."""
    day = F.col("date")
    return df.where(calendar.contains(day)).withColumn("day_index", calendar.day_index(day))


def sparse_vectors(df: DataFrame, key: str, value: str) -> DataFrame:
    """(name, days, vals): the dates (as day numbers) and values of each name.

    ``df`` has at most one row per name and day, so a vector is never longer
    than the number of distinct days.
    """
    entries = F.array_sort(
        F.collect_list(
            F.struct(
                F.unix_date("date").alias("day"), F.col(value).cast("double").alias("val")
            )
        )
    )
    return (
        df.where(F.col(key).isNotNull() & F.col("date").isNotNull() & F.col(value).isNotNull())
        .groupBy(F.col(key).cast("string").alias("name"))
        .agg(entries.alias("entries"))
        .select(
            "name",
            F.col("entries.day").alias("days"),
            F.col("entries.val").alias("vals"),
        )
    )


def series_vectors(
    df: DataFrame, calendar: WeekdayCalendar, key: str = "series", value: str = "value"
) -> DataFrame:
    """(name, vector): values in date order, one position per calendar slot.

    Slots without a row are null.  ``df`` has at most one row per name and day.
    """
    slot, size = calendar.slot(F.col("date")), calendar.size
    entries = F.array_sort(
        F.collect_list(F.struct(slot.alias("slot"), F.col(value).cast("double").alias("val")))
    )
    # Complete series, the usual case, take their values as they stand.
    dense = F.col("entries.val")
    gathered = (
        df.where(F.col(key).isNotNull() & calendar.contains(F.col("date")))
        .groupBy(F.col(key).cast("string").alias("name"))
        .agg(entries.alias("entries"))
    )
    # For an incomplete series: walk the sorted entries once, adding nulls for
    # the slots that were jumped over, then the nulls after the last entry.
    nulls = lambda n: F.array_repeat(F.lit(None).cast("double"), n)
    pieces = F.transform(
        F.col("entries"),
        lambda e, i: F.concat(
            nulls(
                e["slot"]
                - F.when(i == 0, F.lit(0)).otherwise(
                    F.get(F.col("entries"), i - 1)["slot"] + 1
                )
            ),
            F.array(e["val"]),
        ),
    )
    tail = nulls(F.lit(size - 1) - F.element_at("entries", -1)["slot"])
    return gathered.select(
        "name",
        F.when(F.size("entries") == size, dense)
        .otherwise(F.concat(F.flatten(pieces), tail))
        .alias("vector"),
    )
