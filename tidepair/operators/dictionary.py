"""Names to dense integers and back."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepair.functions.prefix import with_running_total
from tidepair.session import materialize

# A dictionary up to this size is broadcast; a row has an id and some overhead
# besides the name.
BROADCAST_BYTES = 32 << 20
ROW_BYTES = 40
# A name is hot with more than this share of all rows: at most 1,000 names are.
HOT_SHARE = 0.001


@dataclass(frozen=True)
class Dictionary:
    """(name, id, hot) with ids 0 .. size-1 in name order.  A hot name has more than
    ``HOT_SHARE`` of the rows that the dictionary was built from."""

    table: DataFrame
    size: int
    bytes: int


def build_dictionary(df: DataFrame, column: str) -> Dictionary:
    """Number the distinct non-null names of a column."""
    names = (
        df.select(F.col(column).cast("string").alias("name"))
        .where("name IS NOT NULL")
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("_one", F.lit(1).cast("bigint"))
    )
    numbered = materialize(with_running_total(names, "name", "_one", "id"), "dictionary")
    size, total, rows = numbered.agg(
        F.count(F.lit(1)), F.sum(F.octet_length("name") + ROW_BYTES), F.sum("rows")
    ).first()
    hot = F.col("rows") > HOT_SHARE * (rows or 0)
    return Dictionary(
        numbered.select("name", (F.col("id") - 1).alias("id"), hot.alias("hot")), size, total or 0
    )


def _look_up(df: DataFrame, lookup: DataFrame, key: str, size: int) -> DataFrame:
    """Inner join to a table (key, value, hot) that is unique on ``key``.

    A small dictionary is broadcast.  Of a large one only the hot names are, at
    most 1 / ``HOT_SHARE``, so their rows stay where they are, however many and
    alike; all other rows are shuffled by key.
    """
    if size <= BROADCAST_BYTES:
        return df.join(F.broadcast(lookup.drop("hot")), key)
    hot = F.broadcast(lookup.where("hot").drop("hot"))
    rest = df.join(hot.select(key), key, "left_anti")
    return df.join(hot, key).unionByName(rest.join(lookup.where("NOT hot").drop("hot").hint("merge"), key))


def encode(df: DataFrame, dictionary: Dictionary, column: str, id_column: str) -> DataFrame:
    """Replace a name column by its id."""
    lookup = dictionary.table.select(F.col("name").alias(column), F.col("id").alias(id_column), "hot")
    return _look_up(df, lookup, column, dictionary.bytes).drop(column)


def decode(df: DataFrame, dictionary: Dictionary, id_column: str, column: str) -> DataFrame:
    """Replace an id column by its name."""
    lookup = dictionary.table.select(F.col("id").alias(id_column), F.col("name").alias(column), "hot")
    return _look_up(df, lookup, id_column, dictionary.bytes).drop(id_column)


# A dictionary that grows is a folder: one table of new names for each version, and
# one short row for each finished version.
VERSION_SCHEMA = "name string, id bigint, version bigint"
HEAD_SCHEMA = "number bigint, size bigint, bytes bigint"


def _heads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HEAD_SCHEMA).option("recursiveFileLookup", True).parquet(f"{path}/heads")


def _known(spark: SparkSession, path: str, last: int) -> DataFrame:
    names = spark.read.schema(VERSION_SCHEMA).parquet(f"{path}/names")
    return names.where(F.col("version").between(1, last)).select("name", "id")


def _total(spark: SparkSession, path: str, version: int | None) -> tuple[int, int, int]:
    """(last version, names, bytes) up to a version, by default the last finished one."""
    heads = _heads(spark, path)
    if version is not None:
        heads = heads.where(F.col("number") <= version)
    last, size, total = heads.agg(F.max("number"), F.sum("size"), F.sum("bytes")).first()
    return last or 0, size or 0, total or 0


def grow_dictionary(df: DataFrame, column: str, path: str) -> Dictionary:
    """Add the new names of a column to the dictionary at ``path`` as its next version.

    Ids of known names never change; new ones get the next ids, in name order.  Only
    new names are numbered and written, so a version costs what it adds besides one
    join of names.  The row that finishes a version is written last: a version that
    failed is not read and is replaced by the next call.  One writer at a time.
    """
    spark = df.sparkSession
    # both tables exist, without rows, before the first version
    spark.createDataFrame([], "name string, id bigint").write.mode("ignore").parquet(f"{path}/names/version=0")
    spark.createDataFrame([], HEAD_SCHEMA).write.mode("ignore").parquet(f"{path}/heads/version=0")
    last, size, _ = _total(spark, path, None)
    counts = materialize(
        df.select(F.col(column).cast("string").alias("name"))
        .where("name IS NOT NULL")
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("rows")),
        "names",
    )
    fresh = counts.join(_known(spark, path, last), "name", "left_anti")
    numbered = with_running_total(
        fresh.withColumn("_one", F.lit(1).cast("bigint")), "name", "_one", "_number"
    )
    here = f"{path}/names/version={last + 1}"
    numbered.select("name", (F.col("_number") - 1 + size).alias("id")).write.mode("overwrite").parquet(here)
    added = spark.read.schema("name string, id bigint").parquet(here)
    head = added.agg(
        F.lit(last + 1).cast("bigint").alias("number"),
        F.count(F.lit(1)).alias("size"),
        F.coalesce(F.sum(F.octet_length("name") + ROW_BYTES), F.lit(0)).cast("bigint").alias("bytes"),
    )
    head.write.mode("overwrite").parquet(f"{path}/heads/version={last + 1}")
    # at most 1 / HOT_SHARE names are hot in the rows that were added
    rows = counts.agg(F.sum("rows")).first()[0] or 0
    hot = counts.where(F.col("rows") > HOT_SHARE * rows).select("name", F.lit(True).alias("hot"))
    grown = read_dictionary(spark, path)
    table = grown.table.drop("hot").join(F.broadcast(hot), "name", "left")
    return replace(grown, table=table.withColumn("hot", F.coalesce("hot", F.lit(False))))


def read_dictionary(spark: SparkSession, path: str, version: int | None = None) -> Dictionary:
    """The dictionary at ``path`` as it is, or as it was at a version.  No name counts as hot."""
    last, size, total = _total(spark, path, version)
    return Dictionary(_known(spark, path, last).withColumn("hot", F.lit(False)), size, total)
