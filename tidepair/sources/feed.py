"""Event feeds: text lines ``"sid,item"`` or columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def open_feed(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """An unbounded source by format name (file formats, kafka, socket, rate)."""
    path = options.pop("path", None)
    schema = options.pop("schema", None)
    reader = spark.readStream.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def parse_feed(lines: DataFrame, ts: Column, line: str = "value") -> DataFrame:
    """(ts, sid, item) from text lines; lines that do not parse are left out."""
    parts = F.split(F.col(line), ",")
    return lines.select(
        ts.alias("ts"),
        F.get(parts, F.lit(0)).try_cast("bigint").alias("sid"),
        F.get(parts, F.lit(1)).try_cast("bigint").alias("item"),
    ).where("sid IS NOT NULL AND item IS NOT NULL")


def utc_timestamp(naive: Column) -> Column:
    """A timestamp without zone read as UTC, whatever the session's zone is.

    Watermarks need a timestamp with an instant.
    """
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), naive).cast("timestamp")


def naive_utc(ts: Column) -> Column:
    """Inverse of :func:`utc_timestamp`."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz")
    )
