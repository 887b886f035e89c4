"""Cosine similarity of every series with every aggregated pair of topics.

For a series x and topics a, b the scores are cos(x, mean(a, b)),
cos(x, min(a, b)) and cos(x, max(a, b)), element by element over the days that
all three have.  A zero norm gives a null score.

Inputs: ``series`` (series, date, value) and ``visits`` (topic, date, visit).
Values that are null, NaN or infinite count as missing, in all forms.  Of several
rows of a series and day the least value stays, as in cleaning; repeated visits
are added up.

Three forms with equal results:

* :func:`cosine_aligned` works on vectors in matrix blocks; there is no row per
  (series, pair, day).  Blocks of topics and parts of the series meet in tiles.
  The default.
* :func:`cosine_aligned_broadcast` joins on the date with the pair series
  broadcast, if they are small; else it is :func:`cosine_aligned`.
* :func:`cosine_vectors` is SQL over arrays on the calendar.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepair.functions.calendar import WeekdayCalendar
from tidepair.functions.vectors import register_cosine
from tidepair.operators.align import align_to_calendar, series_vectors, sparse_vectors, sum_visits
from tidepair.operators.bounds import BoundedTopKernel
from tidepair.operators.pairs import pair_series
from tidepair.operators.tiles import CosineKernel, run_tiles
from tidepair.session import materialize, shuffle_partitions, tile_side

# Memory of one block of topics in a task, laid out over all days: values, presence
# and their products, as doubles.
BLOCK_BYTES = 64 << 20
DAY_BYTES = 32
# Upper bound for the pair series in the broadcast form, and the size of one
# of its rows without the two names (a date, three doubles, row overhead).
PAIR_BROADCAST_BYTES = 64 << 20
PAIR_ROW_BYTES = 72

MEASURES = ("mean", "min", "max")
SCORE_SCHEMA = (
    "series string, topic1 string, topic2 string, cos_mean double, cos_min double, cos_max double"
)
TOP_SCHEMA = "measure string, series string, topic1 string, topic2 string, similarity double"


def _run(
    series: DataFrame,
    visits: DataFrame,
    kernel: Callable[[], CosineKernel],
    schema: str,
    topics_per_block: int | None,
) -> DataFrame:
    """Bring series vectors and topic vectors together in the kernel.

    The topic vectors are written once and their number and days measured, as a
    task lays a block of them out over all days.  Series vectors are never counted
    or gathered: they stream past.
    """
    topics = materialize(
        sparse_vectors(sum_visits(usable(visits, "visit")), "topic", "visit"), "topics"
    )
    vectors = sparse_vectors(one_value(series), "series", "value")
    count, first, last = topics.agg(
        F.count(F.lit(1)), F.min(F.array_min("days")), F.max(F.array_max("days"))
    ).first()
    if topics_per_block is None:
        days = last - first + 1 if count else 1
        topics_per_block = max(1, BLOCK_BYTES // (days * DAY_BYTES))
    rows, tiles = _tiles(vectors, topics, max(1, math.ceil(count / topics_per_block)))
    return run_tiles(rows, ["part", "low", "high"], "name", kernel, schema, tiles)


def usable(df: DataFrame, value: str) -> DataFrame:
    """The rows with a finite value."""
    number = F.col(value).cast("double")
    return df.where(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf")))


def one_value(series: DataFrame) -> DataFrame:
    """One row for each series and day.  Needs no shuffle if the rows are already
    partitioned by series."""
    known = usable(series, "value").where("series IS NOT NULL AND date IS NOT NULL")
    return known.groupBy("series", "date").agg(F.min("value").alias("value"))


def _tiles(vectors: DataFrame, topics: DataFrame, topic_blocks: int) -> tuple[DataFrame, int]:
    """Copies of topics as sides 0 and 1 of their tiles, and series as side 2; and
    the number of tiles.

    A tile is two topic blocks (low <= high) and a part of the series.  The
    number of parts sets the parallelism only.
    """
    tiles = topic_blocks * (topic_blocks + 1) // 2
    parts = max(1, math.ceil(4 * shuffle_partitions(vectors.sparkSession) / tiles))

    def from_to(first: Column | int, last: Column | int) -> Column:
        first, last = (F.lit(v) if isinstance(v, int) else v for v in (first, last))
        return F.explode(F.sequence(first, last))

    own = F.pmod(F.xxhash64("name"), F.lit(topic_blocks)).cast("int")
    blocks = topics.withColumn("own", own)
    # A block is side 1 of the tiles in which it is high, its tile with itself
    # included, and side 0 of those in which it is low.
    high = blocks.select(
        "*", F.lit(1).alias("side"), F.col("own").alias("high"), from_to(0, F.col("own")).alias("low")
    )
    low = blocks.where(F.col("own") < topic_blocks - 1).select(
        "*",
        F.lit(0).alias("side"),
        F.col("own").alias("low"),
        from_to(F.col("own") + 1, topic_blocks - 1).alias("high"),
    )
    columns = ["part", "low", "high", "side", "name", "days", "vals"]
    fixed = high.unionByName(low).withColumn("part", from_to(0, parts - 1)).select(columns)
    streamed = (
        vectors.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(parts)).cast("int"))
        .withColumn("side", F.lit(2))
        .withColumn("low", from_to(0, topic_blocks - 1))
        .withColumn("high", from_to(F.col("low"), topic_blocks - 1))
        .select(columns)
    )
    return fixed.unionByName(streamed), tiles * parts


def cosine_aligned(
    series: DataFrame,
    visits: DataFrame,
    topics_per_block: int | None = None,
) -> DataFrame:
    """(series, topic1, topic2, cos_mean, cos_min, cos_max) for every triple."""
    return _run(series, visits, CosineKernel, SCORE_SCHEMA, topics_per_block)


def top_matches(
    series: DataFrame,
    visits: DataFrame,
    k: int = 20,
    measures: tuple[str, ...] = MEASURES,
    digits: int | None = None,
    topics_per_block: int | None = None,
) -> DataFrame:
    """(measure, series, topic1, topic2, similarity): a superset of the best k
    per measure, from one pass over the series; complete data are scored only where
    a bound allows it.

    ``digits`` says how far scores may be rounded before they are ranked.
    Give the result to :func:`tidepair.operators.topk.top_k`.
    """
    slack = 0.0 if digits is None else 10.0**-digits
    wanted = tuple(measures)
    return _run(
        series,
        visits,
        lambda: BoundedTopKernel(k, wanted, slack),
        TOP_SCHEMA,
        topics_per_block,
    )


def pair_scores(joined: DataFrame) -> DataFrame:
    """Scores from day rows (series, topic1, topic2, value, mean, min, max)."""
    value = F.col("value")
    sums = [F.sum(value * value).alias("xx")]
    for m in MEASURES:
        sums += [
            F.sum(value * F.col(m)).alias(f"xy_{m}"),
            F.sum(F.col(m) * F.col(m)).alias(f"yy_{m}"),
        ]
    return (
        joined.groupBy("series", "topic1", "topic2")
        .agg(*sums)
        .select(
            "series",
            "topic1",
            "topic2",
            *(
                F.try_divide(
                    F.col(f"xy_{m}"), F.sqrt("xx") * F.sqrt(f"yy_{m}")
                ).alias(f"cos_{m}")
                for m in MEASURES
            ),
        )
    )


def cosine_aligned_broadcast(
    series: DataFrame,
    visits: DataFrame,
    broadcast_bytes: int = PAIR_BROADCAST_BYTES,
) -> DataFrame:
    """As :func:`cosine_aligned`, by a date join with the pair series broadcast.

    The visits are summed and written once, and their row and topic counts
    bound the pair series.  Within the bound the join leaves the series'
    partitioning by name as it is, so the sums need no further shuffle; beyond
    it the tiled form takes over.
    """
    summed = materialize(sum_visits(usable(visits, "visit")), "visits")
    rows, topics, name = summed.agg(
        F.count(F.lit(1)), F.count_distinct("topic"), F.max(F.octet_length("topic"))
    ).first()
    # a row of a topic meets at most every other topic, once per pair
    at_most = rows * max(topics - 1, 0) / 2 * (PAIR_ROW_BYTES + 2 * (name or 0))
    if at_most > broadcast_bytes:
        return cosine_aligned(series, summed)
    return pair_scores(one_value(series).join(F.broadcast(pair_series(summed)), "date"))


def cosine_vectors(
    series: DataFrame,
    visits: DataFrame,
    calendar: WeekdayCalendar,
    blocks: int | None = None,
) -> DataFrame:
    """As :func:`cosine_aligned` on calendar days, in SQL over arrays.

    Vectors have one position per calendar slot.  Each pair vector meets each
    series vector in one tile (series block, pair block) of an equi-join; only
    the three scores leave the join.
    """
    spark = series.sparkSession
    register_cosine(spark)
    blocks = blocks or tile_side(spark)
    days = align_to_calendar(sum_visits(usable(visits, "visit")), calendar)
    return spark.sql(
        f"""
        WITH topic_copies AS (
            SELECT name, vector, CAST(pmod(xxhash64(name), {blocks}) AS INT) AS own,
                   explode(sequence(0, {blocks} - 1)) AS other
            FROM {{topics}}),
        low_copies AS (SELECT * FROM topic_copies WHERE own <= other),
        high_copies AS (SELECT * FROM topic_copies WHERE other <= own),
        pairs AS (
            SELECT least(t1.name, t2.name) AS topic1, greatest(t1.name, t2.name) AS topic2,
                   zip_with(t1.vector, t2.vector, (a, b) -> (a + b) / 2) AS mean,
                   zip_with(t1.vector, t2.vector,
                            (a, b) -> if(a IS NULL OR b IS NULL, NULL, least(a, b))) AS min,
                   zip_with(t1.vector, t2.vector,
                            (a, b) -> if(a IS NULL OR b IS NULL, NULL, greatest(a, b))) AS max
            FROM low_copies t1 JOIN high_copies t2
              ON t1.own = t2.other AND t1.other = t2.own
                 AND (t1.own < t2.own OR t1.name < t2.name)),
        pair_copies AS (
            SELECT *, CAST(pmod(xxhash64(topic1, topic2), {blocks}) AS INT) AS pair_block,
                   explode(sequence(0, {blocks} - 1)) AS series_block
            FROM pairs),
        series_copies AS (
            SELECT name, vector, CAST(pmod(xxhash64(name), {blocks}) AS INT) AS series_block,
                   explode(sequence(0, {blocks} - 1)) AS pair_block
            FROM {{series}})
        SELECT s.name AS series, p.topic1, p.topic2,
               cosine_similarity(s.vector, p.mean) AS cos_mean,
               cosine_similarity(s.vector, p.min) AS cos_min,
               cosine_similarity(s.vector, p.max) AS cos_max
        FROM series_copies s JOIN pair_copies p USING (series_block, pair_block)
        WHERE exists(zip_with(s.vector, p.mean, (a, b) -> a IS NOT NULL AND b IS NOT NULL), t -> t)
        """,
        series=series_vectors(one_value(series), calendar),
        topics=series_vectors(days, calendar, "topic", "visit"),
    )
