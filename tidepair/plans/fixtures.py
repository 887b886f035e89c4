"""The inputs of the registered queries, as views of the given tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepair.functions.calendar import WeekdayCalendar
from tidepair.session import partitions_for
from tidepair.sources.feed import utc_timestamp

# A calendar without days, for a table without rows.
NO_DAYS = WeekdayCalendar(date(1970, 1, 2), date(1970, 1, 1))


def event_calendar(spark: SparkSession, sf_dir: str) -> WeekdayCalendar:
    """The weekdays between the first and the last event, from one small aggregate."""
    ends = table(spark, sf_dir, "events").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    first, last = ends.select(F.col("a").cast("date"), F.col("b").cast("date")).first()
    return WeekdayCalendar(first, last) if first else NO_DAYS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(
    spark: SparkSession, sf_dir: str, calendar: WeekdayCalendar | None
) -> DataFrame:
    """The events, within the bounds of a calendar if one is given.

    The bounds are put on the time stamp itself, where the parquet reader can
    use them; a bound on the derived date stays above the scan.
    """
    events = table(spark, sf_dir, "events")
    if calendar is None:
        return events
    after = calendar.end + timedelta(days=1)
    return events.where(
        (F.col("ts") >= F.lit(calendar.start).cast("timestamp_ntz"))
        & (F.col("ts") < F.lit(after).cast("timestamp_ntz"))
    )


def event_prices(
    spark: SparkSession, sf_dir: str, calendar: WeekdayCalendar | None = None
) -> DataFrame:
    """A price panel: one series per user, several rows per day."""
    return _events(spark, sf_dir, calendar).select(
        F.concat(F.col("user_id").cast("string"), F.lit(".U")).alias("series"),
        F.col("ts").cast("date").alias("date"),
        "value",
        "event_id",
    )


def event_visits(
    spark: SparkSession, sf_dir: str, calendar: WeekdayCalendar | None = None
) -> DataFrame:
    """Visits per event type and day; one row per event, each one visit."""
    return _events(spark, sf_dir, calendar).select(
        F.col("event_type").alias("topic"),
        F.col("ts").cast("date").alias("date"),
        F.lit(1).alias("visit"),
    )


def item_visits(spark: SparkSession, sf_dir: str, calendar: WeekdayCalendar) -> DataFrame:
    """Visits per item and weekday of the calendar, 0 on days without any: a topic for each item."""
    seen = (
        _events(spark, sf_dir, calendar)
        .select(
            F.get_json_object("props", "$.k").alias("topic"), F.col("ts").cast("date").alias("date")
        )
        .where("topic IS NOT NULL")
        .groupBy("topic", "date")
        .agg(F.count(F.lit(1)).alias("visit"))
    )
    # every topic meets every day: the days are a short list, so this is a map of the topics
    days = F.filter(
        F.sequence(F.lit(calendar.start), F.lit(calendar.end)), lambda d: calendar.contains(d)
    ) if calendar.size else F.array().cast("array<date>")
    slots = seen.select("topic").distinct().select("topic", F.explode(days).alias("date"))
    return slots.join(seen, ["topic", "date"], "left").select(
        "topic", "date", F.coalesce("visit", F.lit(0)).alias("visit")
    )


def sale_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel with holes: sales per supplier and shipping day.

    Rows are dealt by series, which all that follows groups by, over a number of partitions
    that is stated: theirs would be merged by their bytes, and few bytes are many groups.
    """
    items = table(spark, sf_dir, "lineitem")
    sales = items.select(
        F.col("l_suppkey").cast("string").alias("series"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("price"),
    )
    return (
        sales.repartition(partitions_for(spark, items.count()), "series")
        .groupBy("series", "date")
        .agg(F.sum("price").alias("value"))
    )


def sale_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments per line number and day."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("string").alias("topic"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.lit(1).alias("visit"),
    )


def part_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments per part and day: many topics with few days each."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("topic"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.lit(1).alias("visit"),
    )


def feed_columns(events: DataFrame) -> DataFrame:
    """(ts, sid, item) of an events table, batch or streaming."""
    return events.select(
        utc_timestamp(F.col("ts")).alias("ts"),
        F.col("user_id").alias("sid"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("item"),
    )


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_columns(table(spark, sf_dir, "events"))


def purchase_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of many items, few of them in each stream: the parts that a customer bought."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_custkey").alias("sid"),
        F.col("l_partkey").alias("item"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, as a file or as a folder of files."""
    schema = table(spark, sf_dir, "events").schema
    return feed_columns(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))
