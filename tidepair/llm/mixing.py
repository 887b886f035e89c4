"""A corpus mixed from its sources to target weights, as blocks of words.

* The words of a source are packed into blocks of ``BLOCK`` words.  A source is
  first dealt into parts of about ``PART_WORDS`` words by a hash of the document
  id, and each part is packed by itself, so a hot source is packed by many
  tasks; the last block of a part is short.
* A source gets as many slots of the output as its target takes.  How many of
  them each output shard holds is drawn first: tickets of the sources are dealt
  to shards by a pseudorandom permutation, and counted.  That is a multinomial
  draw for each shard given the totals, so the totals are met.
* The slots of a source are numbered from those counts, shard by shard.  Slot
  number r takes the block at place r of a pseudorandom permutation of the
  source's blocks, a new one for each pass over the source, and blocks are joined
  by that index.  A target is at most twice its source, so no block is taken more
  than twice.

Everything is a function of ids, sizes and the seed: reruns agree.

Defined cases: a null or blank text has size 0 and is never taken; a null source
is a source of its own, sorted last; rows with one id are packed one after the
other; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions
from .common import WORD, whole_text

BLOCK = 64
PART_WORDS = 1 << 20
SHARD_SLOTS = 4096
CHUNK = 8192
SHARD_RUN = 4096
ROUNDS = 12

# Fixed values of the contract: weights in turn, share of all words, largest use of a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """The place of ``index`` in a pseudorandom permutation of 0 .. size - 1.

    Swap-or-not shuffle: each round pairs x with k - x (mod size) and swaps the
    pair or not, by a bit that both partners compute alike.  Works for any size.
    """

    def turn(x: Column, r: Column) -> Column:
        partner = F.pmod(F.xxhash64(*key, r) - x, size)
        bit = F.xxhash64(*key, r, F.greatest(x, partner)).bitwiseAND(F.lit(1))
        return F.when(bit == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), turn)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): one short row for each document."""
    return docs.select(
        "doc_id", "source", F.regexp_count(whole_text(), F.lit(WORD)).cast("long").alias("size")
    )


def targets(sizes: DataFrame) -> DataFrame:
    """(source, weight, source_size, target), one row for each source.

    A target is the smaller of ``MOST`` times the source and a common level times
    the weight.  With sources sorted by their cap over weight, those that reach
    the cap come first, so running sums give the level: the same as sharing the
    excess again until none is above.  One row for each source is sorted here.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    placed = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.get(weights, F.pmod(F.row_number().over(by_name) - 1, len(WEIGHTS))))
        .withColumn("_cap", F.col("source_size") * MOST)
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn("_total", F.sum("source_size").over(every) * SHARE)
        .withColumn("_weights", F.sum("weight").over(every))
        .withColumn("_caps_before", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weights_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    level = (F.col("_total") - F.col("_caps_before")) / (F.col("_weights") - F.col("_weights_before"))
    full = placed.withColumn("_full", F.col("_ratio") <= level)
    rest = (F.col("_total") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(every)) / (
        F.sum(F.when(~F.col("_full"), F.col("weight"))).over(every)
    )
    return full.select(
        "source",
        "weight",
        "source_size",
        F.when(F.col("_full"), F.col("_cap").cast("double"))
        .otherwise(F.col("weight") * rest)
        .alias("target"),
    )


def _by_source(left: DataFrame, right: DataFrame, *more: str, how: str = "inner") -> DataFrame:
    """Join on source, where null meets null, and on further columns."""
    for name in ("source", *more):
        right = right.withColumnRenamed(name, f"_{name}")
    on = F.col("source").eqNullSafe(F.col("_source"))
    for name in more:
        on &= F.col(name) == F.col(f"_{name}")
    return left.join(right, on, how).drop(*(f"_{name}" for name in ("source", *more)))


def pack(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Documents as stretches of their part: (doc_id, source, size, source_size,
    target, part, row, start)."""
    goals = goals.withColumn("_parts", F.ceil(F.col("source_size") / PART_WORDS))
    rows = _by_source(sizes, goals).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.col("_parts") > 0, F.pmod(F.xxhash64("doc_id"), F.col("_parts")))
        .otherwise(0)
        .alias("part"),
    )
    within = Window.partitionBy("source", "part").orderBy("doc_id", "size")
    return rows.withColumn("row", F.row_number().over(within)).withColumn(
        "start",
        F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
    )


def parts(packed: DataFrame) -> DataFrame:
    """(source, part, first, blocks, source_blocks, slots): where the blocks of a
    part begin in the numbering of its source, and the slots of the source."""
    each = packed.groupBy("source", "part").agg(
        F.ceil(F.sum("size") / BLOCK).alias("blocks"),
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
    )
    source = Window.partitionBy("source")
    before = source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        each.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0)))
        .withColumn("source_blocks", F.sum("blocks").over(source))
        .withColumn(
            "slots",
            F.when(
                F.col("source_size") > 0,
                F.round(F.col("target") * F.col("source_blocks") / F.col("source_size")),
            )
            .otherwise(0)
            .cast("long"),
        )
    )


def shard_counts(sources: DataFrame, seed: int = 0) -> DataFrame:
    """(source, shard, slots) for (source, source_blocks, slots): the multinomial draw of
    each output shard, given the slots of all sources.

    Tickets are made in chunks that are dealt to all tasks and counted there first; a
    number of partitions is stated, as adaptive execution would put the short rows of
    chunks into one task.
    """
    before = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    chunks = (
        sources.filter("slots > 0")
        .withColumn("_first", F.coalesce(F.sum("slots").over(before), F.lit(0)))
        .withColumn("_all", F.sum("slots").over(Window.partitionBy()))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.expr(f"(slots - 1) div {CHUNK}"))))
        .repartition(shuffle_partitions(sources.sparkSession), "source", "_chunk")
    )
    begin = F.col("_chunk") * CHUNK
    tickets = chunks.withColumn(
        "_ticket", F.explode(F.sequence(begin, F.least(begin + CHUNK, F.col("slots")) - 1))
    )
    at = permuted(F.col("_first") + F.col("_ticket"), F.col("_all"), F.lit(seed), F.lit("shards"))
    return (
        tickets.select("source", "source_blocks", F.floor(at / SHARD_SLOTS).alias("shard"))
        .groupBy("source", "source_blocks", "shard")
        .agg(F.count("*").alias("slots"))
    )


def slots(counts: DataFrame, seed: int = 0) -> DataFrame:
    """(source, slot, index, shard, place) for the counts of shards: the slots of a source,
    numbered from its counts shard by shard, the block that each takes, and the place that
    it fills in its shard.

    Counts are added up over runs of ``SHARD_RUN`` shards and then over the runs, so no
    task sees all shards of a source.
    """
    runs = counts.withColumn("_run", F.expr(f"shard div {SHARD_RUN}"))
    earlier = Window.partitionBy("source").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        runs.groupBy("source", "_run")
        .agg(F.sum("slots").alias("_slots"))
        .withColumn("_begin", F.coalesce(F.sum("_slots").over(earlier), F.lit(0)))
        .drop("_slots")
    )
    within = Window.partitionBy("source", "_run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shard = Window.partitionBy("shard")
    beside = shard.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        _by_source(runs, begins, "_run")
        .withColumn("_begin", F.col("_begin") + F.coalesce(F.sum("slots").over(within), F.lit(0)))
        .withColumn("_beside", F.coalesce(F.sum("slots").over(beside), F.lit(0)))
        .withColumn("_shard_slots", F.sum("slots").over(shard))
        .repartition(shuffle_partitions(counts.sparkSession), "source", "shard")
    )
    # a shard has at most SHARD_SLOTS slots, so no row grows beyond that; dealt anew with a
    # stated number of partitions, or adaptive execution would put the short rows into one task
    each = numbered.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1))).withColumn(
        "slot", F.col("_begin") + F.col("_at")
    )
    turn = F.expr("slot div source_blocks")
    return each.select(
        "source",
        "slot",
        permuted(
            F.col("slot") % F.col("source_blocks"), F.col("source_blocks"), F.lit(seed), F.col("source"), turn
        ).alias("index"),
        "shard",
        permuted(F.col("_beside") + F.col("_at"), F.col("_shard_slots"), F.lit(seed), F.lit("places"), F.col("shard")).alias(
            "place"
        ),
    )


def pieces(packed: DataFrame, placed: DataFrame) -> DataFrame:
    """The stretch of words that each document has in each block, by block index.
    A document of size 0 has one piece without a block."""
    joined = _by_source(packed, placed.select("source", "part", "first"), "part")
    last = F.expr(f"(start + size - 1) div {BLOCK}")
    covered = F.when(F.col("size") > 0, F.sequence(F.expr(f"start div {BLOCK}"), last))
    block = joined.select("*", F.explode_outer(covered).alias("_block"))
    left = F.greatest(F.col("start"), F.col("_block") * BLOCK)
    right = F.least(F.col("start") + F.col("size"), (F.col("_block") + 1) * BLOCK)
    return block.select(
        "doc_id", "source", "size", "source_size", "target", "part", "row",
        (F.col("first") + F.col("_block")).alias("index"),
        (left - F.col("start")).alias("from_word"),
        (right - left).alias("words"),
    )


def mix_plan(docs: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(pieces of documents in blocks, slots that take blocks)."""
    sizes = materialize(sized(docs), "mix-sizes")
    packed = materialize(pack(sizes, targets(sizes)), "mix-packed")
    placed = materialize(parts(packed), "mix-parts")
    sources = placed.groupBy("source").agg(
        F.first("source_blocks").alias("source_blocks"), F.first("slots").alias("slots")
    )
    counts = materialize(shard_counts(sources, seed), "mix-shards")
    return pieces(packed, placed), slots(counts, seed)


def taken_words(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row for each row of ``docs``."""
    held, mix = mix_plan(docs, seed)
    uses = mix.groupBy("source", "index").agg(F.count("*").alias("_uses"))
    taken = F.coalesce(F.col("_uses"), F.lit(0)) * F.coalesce("words", F.lit(0))
    # one row for each block: never broadcast, though its size is estimated from the sources'
    joined = _by_source(held, uses.hint("merge"), "index", how="left").withColumn("_taken", taken)
    keys = ["source", "part", "row", "doc_id", "size", "source_size", "target"]
    return (
        joined.groupBy(*keys)
        .agg(F.sum("_taken").alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken")
    )
