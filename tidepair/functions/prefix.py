"""Running totals over a whole table, in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepair.session import materialize


def with_running_total(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Add ``out`` = sum of ``value`` over all rows up to this one by ``order``.

    ``order`` must be unique.  The rows are range partitioned and written once;
    each range sums its own rows, and the totals of the ranges before it (one
    row per range, so bounded by the number of partitions) are broadcast.  No
    task sees more than one range.
    """
    ranged = materialize(
        df.repartitionByRange(F.col(order)).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    before = (
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_total"))
    offsets = totals.select(
        "_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset")
    )
    within = (
        Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(out, F.sum(value).over(within) + F.col("_offset"))
        .drop("_range", "_offset")
    )
