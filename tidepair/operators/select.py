"""Choose and describe series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepair.functions.names import numeric_prefix
from tidepair.session import BROADCAST_ROWS


def limit_series(panel: DataFrame, n: int = 1000) -> DataFrame:
    """Rows of the first ``n`` series by the number their name starts with.

    Names without a number come first; names with the same number are taken in
    name order.  The chosen names are at most ``n`` rows, so they are broadcast
    when ``n`` is within the bound, and the panel is not shuffled.  The panel is
    read twice, the first time for its names only, so give it a table.
    """
    chosen = (
        panel.select("series")
        .distinct()
        .orderBy(numeric_prefix(F.col("series")).asc_nulls_first(), "series")
        .limit(n)
    )
    if n <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    return panel.join(chosen, "series", "left_semi")


def describe_series(panel: DataFrame) -> DataFrame:
    """One row of statistics over a panel."""
    return panel.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("series").alias("series_count"),
        F.min("series").alias("series_min"),
        F.max("series").alias("series_max"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        F.count("value").alias("value_count"),
        F.avg("value").alias("value_mean"),
        F.stddev_samp("value").alias("value_stddev"),
        F.min("value").alias("value_min"),
        F.max("value").alias("value_max"),
    )
