"""Best matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(scores: DataFrame, measure: str, k: int = 20, digits: int | None = None) -> DataFrame:
    """(series, topic1, topic2, similarity): the k best by one measure.

    Takes either all scores (a column ``cos_<measure>``) or the rows of
    ``top_matches`` (a column ``measure``).  Null and NaN scores are left out; ties are
    broken by series and topics.  ``digits`` rounds before ranking.
    """
    if "measure" in scores.columns:
        rows = scores.where(F.col("measure") == measure)
        score = F.col("similarity")
    else:
        rows = scores
        score = F.col(f"cos_{measure}")
    if digits is not None:
        score = F.round(score, digits)
    return (
        rows.select("series", "topic1", "topic2", score.alias("similarity"))
        .where("similarity IS NOT NULL AND NOT isnan(similarity)")
        .orderBy(F.col("similarity").desc(), "series", "topic1", "topic2")
        .limit(k)
    )


def best_per_measure(matches: DataFrame, k: int = 20, digits: int | None = None) -> DataFrame:
    """(measure, position, series, topic1, topic2, similarity) for the rows of
    ``top_matches``: the k best of every measure from one pass.

    The limit on the position goes below the shuffle, so a map task passes on
    at most k rows per measure.
    """
    score = F.col("similarity")
    if digits is not None:
        score = F.round(score, digits)
    order = Window.partitionBy("measure").orderBy(
        F.col("similarity").desc(), "series", "topic1", "topic2"
    )
    return (
        matches.select("measure", "series", "topic1", "topic2", score.alias("similarity"))
        .where("similarity IS NOT NULL AND NOT isnan(similarity)")
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= k)
    )
