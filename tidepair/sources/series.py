"""Daily series from and to CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File layout of the two inputs.
DATE_FORMAT = "MM/dd/yyyy"
PRICE_SCHEMA = "series string, date date, value double, volume int"
VISIT_SCHEMA = "topic string, date date, visit bigint"


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Headerless price files; a field that does not parse is null.

    The volume is not asked for, so the parser skips it.
    """
    return (
        spark.read.schema(PRICE_SCHEMA)
        .option("dateFormat", DATE_FORMAT)
        .csv(path)
        .select("series", "date", "value")
    )


def read_visits(spark: SparkSession, path: str) -> DataFrame:
    """Visit files with a header line."""
    return (
        spark.read.schema(VISIT_SCHEMA)
        .option("header", True)
        .option("dateFormat", DATE_FORMAT)
        .csv(path)
    )


def read_visits_untyped(spark: SparkSession, path: str) -> DataFrame:
    """Visit files whose columns arrive as text, found by header name."""
    text = spark.read.option("header", True).csv(path)
    return text.select(
        "topic",
        F.coalesce(
            F.try_to_date("date", DATE_FORMAT), F.try_to_date("date")
        ).alias("date"),
        F.col("visit").try_cast("double").alias("visit"),
    )


def write_prices(df: DataFrame, path: str) -> None:
    """Write (series, date, value, volume) in the layout of :func:`read_prices`."""
    df.select("series", "date", "value", "volume").write.option(
        "dateFormat", DATE_FORMAT
    ).csv(path)


def write_visits(df: DataFrame, path: str) -> None:
    df.select("topic", "date", "visit").write.option("header", True).option(
        "dateFormat", DATE_FORMAT
    ).csv(path)
