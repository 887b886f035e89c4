"""Late rows of a live feed as a side output, and the record of each batch.

Each micro-batch is written in one pass, parted into rows on time and late ones, and
the same pass observes what the record of the batch needs: its rows, its late rows,
its last instant.  Records are kept in a table, so the watermark of a batch comes from
the records of the batches before it.  A record is written last: rows of a batch without
one are not read.  A repeated batch finds the same earlier records and replaces what
it wrote, so every row is routed exactly once over failures and restarts.

A row is late if its pane had ended by the watermark when its batch began: ``delay`` before
the last instant of the batches before.  Rows without a time are in no pane and never late.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidepair.operators.sketch import interval_micros
from tidepair.streaming.similarity import DEFAULT_SLIDE, DEFAULT_TRIGGER, _trigger

RECORD_SCHEMA = "batch bigint, rows bigint, late bigint, last timestamp, watermark timestamp"
LATE, ON_TIME = "late", "on_time"


def pane_end(slide: str, ts: Column | str = "ts") -> Column:
    """End of the tumbling pane of an instant, null for a null one."""
    step = interval_micros(slide)
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, step) + step)


def _records(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(RECORD_SCHEMA).option("recursiveFileLookup", True).parquet(f"{out}/records")


def write_record(record: DataFrame, path: str) -> None:
    """Finish a batch: from here on its rows are read."""
    record.coalesce(1).write.mode("overwrite").parquet(path)


def start_routing(
    feed: DataFrame,
    out: str,
    slide: str = DEFAULT_SLIDE,
    delay: str = DEFAULT_SLIDE,
    once: bool = False,
    every: str = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """Write the rows of ``feed`` to ``out``/routed, on time and late apart, and a record of
    each batch to ``out``/records."""
    if clash := {"routed_batch", "routed_side"} & {c.lower() for c in feed.columns}:
        raise ValueError(f"columns {sorted(clash)} are used for routing")
    spark = feed.sparkSession
    # both tables exist, without rows, before the first batch
    for path, schema in (
        ("records/routed_batch=-1", RECORD_SCHEMA),
        (f"routed/routed_batch=-1/routed_side={ON_TIME}", feed.schema),
    ):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{out}/{path}")

    def route(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        watermark = (
            _records(session, out)
            .where(F.col("batch") < batch_id)
            .agg((F.max("last") - F.expr(f"INTERVAL {delay}")).alias("watermark"))
            .select(F.unix_micros("watermark"))
            .first()[0]
        )
        mark = F.timestamp_micros(F.lit(watermark).cast("bigint"))
        late = F.coalesce(pane_end(slide) <= mark, F.lit(False))
        seen = Observation()
        (
            batch.withColumn("routed_side", F.when(late, LATE).otherwise(ON_TIME))
            .observe(
                seen,
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col("routed_side") == LATE).alias("late"),
                F.max(F.unix_micros("ts")).alias("last"),
            )
            .write.mode("overwrite")
            .partitionBy("routed_side")
            .parquet(f"{out}/routed/routed_batch={batch_id}")
        )
        found = seen.get
        record = session.range(1).select(
            F.lit(batch_id).cast("bigint").alias("batch"),
            F.lit(found["rows"]).cast("bigint").alias("rows"),
            F.lit(found["late"]).cast("bigint").alias("late"),
            F.timestamp_micros(F.lit(found["last"]).cast("bigint")).alias("last"),
            mark.alias("watermark"),
        )
        write_record(record, f"{out}/records/routed_batch={batch_id}")

    return (
        feed.writeStream.foreachBatch(route)
        .option("checkpointLocation", f"{out}/state-routing")
        .trigger(**_trigger(once, every))
        .start()
    )


def _routed(spark: SparkSession, out: str, schema: T.StructType, side: str) -> DataFrame:
    more = T.StructType([T.StructField("routed_batch", T.LongType()), T.StructField("routed_side", T.StringType())])
    whole = _records(spark, out).select(F.col("batch").alias("routed_batch"))
    return (
        spark.read.schema(T.StructType([*schema, *more]))
        .option("basePath", f"{out}/routed")
        .parquet(f"{out}/routed")
        .where(F.col("routed_side") == side)
        .join(whole, "routed_batch", "left_semi")
        .drop("routed_side")
    )


def read_late(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The late rows, with the number of their batch as ``routed_batch``."""
    return _routed(spark, out, schema, LATE)


def read_on_time(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """All other rows, with the number of their batch as ``routed_batch``."""
    return _routed(spark, out, schema, ON_TIME)


def read_record(spark: SparkSession, out: str) -> DataFrame:
    """(batch, rows, late, last, watermark, rows_so_far), one short row for each batch of the run."""
    before = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return _records(spark, out).withColumn("rows_so_far", F.sum("rows").over(before))
