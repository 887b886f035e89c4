"""Similar streams by a Count-Min sketch.

A feed has (ts, sid, item).  Cell ``n[s, f, v]`` counts the events of stream s
whose item falls in bucket v of hash function f.  The similarity of two streams
is the least, over the functions, of the inner product of their cell rows; it
is never below the exact inner product of their item counts.

Streams meet in tiles of sketch blocks (a matrix product per function), not by
a join on buckets: a popular item makes one bucket hot, and a join would emit
every pair of streams in it.  Here a bucket is a matrix column and only pairs
above the threshold are emitted.  Blocks of streams that are too small to reach
the threshold with each other are never brought together.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepair.functions.hashing import DEFAULT_THRESHOLD, HashFamily, hashed_cells
from tidepair.operators.tiles import SketchClassKernel, SketchGridKernel, SketchKernel, SketchListKernel, run_tiles
from tidepair.session import BROADCAST_ROWS, discard, materialize, shuffle_partitions

# Memory of one block of sketches in a task, as lists of cells and a copy of them, and the
# most streams of a block.
BLOCK_BYTES = 256 << 20
MAX_BLOCK = 1 << 18
# A block is not cut below this many streams for the sake of parallelism.
MIN_BLOCK = 128
# Streams of equal sketches are compared once if there are so many to a sketch, on average,
# and are kept in rows of about half so many names, at most.
EQUAL_STREAMS = 4
CLASS_STREAMS = 1024
# Inner products may be of any size below this many digits.
WHOLE = "decimal(38,0)"


def _count_cells(feed: DataFrame, keys: list[str], family: HashFamily) -> DataFrame:
    """Count events per (keys, f, v).

    The buckets are expanded inside the map stage and counted there first, so a
    hot stream or item leaves a map task as a bounded number of cells.
    """
    return (
        feed.where("sid IS NOT NULL AND item IS NOT NULL")
        .withColumn("sid", F.col("sid").cast("bigint"))
        .select(*keys, F.inline(hashed_cells(F.col("item").cast("bigint"), family)))
        .groupBy(*keys, "f", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def sketch_cells(feed: DataFrame, family: HashFamily) -> DataFrame:
    """(sid, f, v, n) over the whole feed."""
    return _count_cells(feed, ["sid"], family)


def pane_cells(feed: DataFrame, family: HashFamily, slide: str) -> DataFrame:
    """(pane, sid, f, v, n): cells per tumbling pane, one slide long.

    For batch and streaming; a streaming feed needs a watermark on ``ts``.
    """
    return _count_cells(feed.withColumn("pane", F.window("ts", slide)), ["pane", "sid"], family)


# A chunk of time spans so many windows' sizes: a pane goes to one chunk, or to two
# where its windows cross from one to the next.
CHUNK_SIZES = 8


def interval_micros(interval: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {interval}"))


def window_cells(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """(chunk, window, sid, f, v, n, fresh): cells per sliding window, from its panes.

    Events are counted once per pane.  Panes are dealt to tasks by stream and chunk of
    time, and only there copied to the windows that overlap them: what is shuffled is
    the panes, at most ``1 + 1 / CHUNK_SIZES`` times, however many windows overlap.
    Sketches are gathered in the same place.  ``fresh`` is the part of ``n`` from the
    window's last pane.
    """
    span, step = interval_micros(size), interval_micros(slide)
    chunk, last = span * CHUNK_SIZES, F.unix_micros("pane.start")
    first = last - F.floor((span - step) / step) * step
    # the number of partitions is stated: panes are few bytes before they are copied
    dealt = panes.select(
        "sid", "f", "v", "n", first.alias("first"), last.alias("last"), F.unix_micros("pane.end").alias("pane_end"),
        F.explode(F.sequence(F.floor(first / chunk), F.floor(last / chunk))).alias("chunk"),
    ).repartition(shuffle_partitions(panes.sparkSession), "chunk", "sid")
    # copies are made where the panes are, and keep their partitioning
    spread = (
        dealt.withColumn("start", F.explode(F.sequence("first", "last", step)))
        .where(F.floor(F.col("start") / chunk) == F.col("chunk"))
    )
    last_pane = F.col("pane_end") == F.col("start") + span
    window = F.struct(
        F.timestamp_micros("start").alias("start"), F.timestamp_micros(F.col("start") + span).alias("end")
    )
    return (
        spread.groupBy("chunk", "start", "sid", "f", "v")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(last_pane, F.col("n")).otherwise(0)).alias("fresh"),
        )
        .select("chunk", window.alias("window"), "sid", "f", "v", "n", "fresh")
    )


def build_sketches(cells: DataFrame, family: HashFamily, marked: bool = False) -> DataFrame:
    """One row per window (if there are windows) and stream, written once.

    A row holds the non-zero cells of the stream, at most depth x buckets, its
    squared norm under each function, and its number of events; the events of
    the window's last pane too, if the cells know them.  If it is ``marked``, a
    hash of the cells, as :func:`merge_equal` needs it.  Cells are in ascending order.
    """
    window_end = F.unix_micros("window.end") if "window" in cells.columns else F.lit(0).cast("bigint")
    cells = cells.withColumn("window_end", window_end)
    keys = [c for c in ("chunk", "window_end", "sid") if c in cells.columns]
    if "chunk" not in cells.columns:
        # cells of a stream come from many tasks: as rows they are a fraction of what they are
        # as lists of a few cells, each with the sums of its own
        cells = cells.repartition(*(["window_end"] if "window" in cells.columns else []), "sid")
    cell = F.col("f") * F.lit(family.buckets) + F.col("v")
    entries = F.collect_list(
        F.struct(cell.cast("int").alias("cell"), F.col("n").cast("bigint").alias("n"))
    )
    n = F.col("n").cast("double")
    sums = [
        F.sum(F.when(F.col("f") == f, n * n).otherwise(0.0)).alias(f"square{f}")
        for f in range(family.depth)
    ]
    # every event is in one cell of each function
    counts = {"n": "events", "fresh": "fresh"}
    sums += [
        F.sum(F.when(F.col("f") == 0, F.col(c)).otherwise(0)).alias(name)
        for c, name in counts.items()
        if c in cells.columns
    ]
    if marked:
        sums.append(F.bit_xor(F.xxhash64("f", "v", F.col("n").cast("bigint"))).alias("mark"))
    sketches = (
        cells.groupBy(*keys)
        .agg(F.sort_array(entries).alias("entries"), *sums)
        .withColumns(
            {
                "cells": F.col("entries.cell"),
                "counts": F.col("entries.n"),
            }
        )
        .drop("entries", "chunk")
    )
    return materialize(sketches, "sketches")


def merge_equal(sketches: DataFrame) -> DataFrame | None:
    """One row per sketch with its streams in ``sids``, the least of them ``sid``, written once
    in place of ``sketches``; none if few are equal.

    Streams with few events, or copies of one another, have equal sketches; one product
    stands for all their pairs.  A sketch of very many streams has several rows.
    """
    sizes = sketches.groupBy("window_end", "mark").agg(F.count(F.lit(1)).alias("streams"))
    total, kinds, large = sizes.agg(
        F.sum("streams"), F.count(F.lit(1)), F.count_if(F.col("streams") > CLASS_STREAMS)
    ).first()
    if not total or total < EQUAL_STREAMS * kinds:
        return None
    piece = F.lit(0).cast("bigint")
    if large:
        parts = sizes.where(F.col("streams") > CLASS_STREAMS).select(
            "window_end", "mark", F.ceil(F.col("streams") * 2 / CLASS_STREAMS).alias("parts")
        )
        parts = F.broadcast(parts) if large <= BROADCAST_ROWS else parts
        sketches_in_parts = sketches.join(parts, ["window_end", "mark"], "left")
        piece = F.coalesce(F.pmod(F.xxhash64("sid"), F.col("parts")), piece)
    else:
        sketches_in_parts = sketches
    squares = [c for c in sketches.columns if c.startswith("square")]
    # the hash only deals the rows: what is grouped are the cells themselves
    merged = (
        sketches_in_parts.select(
            "window_end", "mark", "sid", *squares, piece.alias("piece"), "cells", "counts"
        )
        .groupBy("window_end", "mark", "piece", "cells", "counts")
        .agg(F.sort_array(F.collect_list("sid")).alias("sids"), *(F.max(s).alias(s) for s in squares))
        .select("window_end", F.col("sids")[0].alias("sid"), "sids", *squares, "cells", "counts")
    )
    merged = materialize(merged, "classes")
    discard(sketches)
    return merged


# Bytes of the types that lists of cells and counts are sent in.
TYPE_BYTES = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}


def _narrowest(most: float) -> str:
    """The narrowest type of whole numbers up to ``most``."""
    return next((t for t, size in TYPE_BYTES.items() if most < 2 ** (8 * size - 1)), "bigint")


def _blocks(
    sketches: DataFrame, family: HashFamily, threshold: int, streams_per_block: int | None
) -> tuple[Column, Column, int, int, tuple[str, str]]:
    """(block of a stream, first block it can have a partner in, number of
    blocks, upper bound of the number of windows, types of cells and counts).

    Streams are blocked by the power of two below their squared norm under the
    first function, shorter ones first, and by a hash among equals.  An inner
    product is at most the product of the norms, so a stream's partners above
    the threshold lie in a run of blocks that ends with the last one; tiles
    outside it are never made.
    """
    spark = sketches.sparkSession
    power = F.floor(F.log2("square0")).cast("int")
    names = F.size("sids") if "sids" in sketches.columns else F.lit(1)
    squares = [F.col(c) for c in sketches.columns if c.startswith("square")]
    # one row per power of two: the most streams it has in a window
    counts = (
        sketches.groupBy("window_end", power.alias("power"))
        .agg(
            F.count(F.lit(1)).alias("streams"),
            F.sum(names).alias("names"),
            F.max(F.size("cells")).alias("widest"),
            F.max(names).alias("most_names"),
            F.max(F.greatest(*squares, F.lit(0.0))).alias("square"),
        )
        .groupBy("power")
        .agg(
            F.max("streams").alias("streams"),
            F.max("names").alias("names"),
            F.count(F.lit(1)).alias("windows"),
            F.max("widest").alias("widest"),
            F.max("most_names").alias("most_names"),
            F.max("square").alias("square"),
        )
        .orderBy("power")
        .collect()
    )
    if not counts:
        return F.lit(0), F.lit(0), 1, 0, ("int", "bigint")
    # no count is above the root of a square
    most = math.sqrt(max(r["square"] for r in counts)) * (1 + 1e-9) + 1
    types = _narrowest(family.depth * family.buckets), _narrowest(most)
    cell_bytes = sum(TYPE_BYTES[t] for t in types)
    # the rows as they come and in one piece
    widest = 2 * max(r["widest"] * cell_bytes + (r["most_names"] + 2) * 8 for r in counts)
    capacity = BLOCK_BYTES // widest
    size = streams_per_block or max(1, min(MAX_BLOCK, capacity))
    if streams_per_block is None:
        streams = sum(r["streams"] for r in counts)
        windows = max(r["windows"] for r in counts)
        # a stream is copied once for each block, so there are no more than tasks need
        spread = max(1, round(math.sqrt(4 * shuffle_partitions(spark) / windows)))
        # rows of many streams are more work, so fewer of them are a block
        least = max(1, MIN_BLOCK * streams // sum(r["names"] for r in counts))
        size = min(size, max(least, math.ceil(streams / spread)))
    # Neighbouring powers share blocks until a block is full.
    groups: list[tuple[list[int], int]] = []
    for r in counts:
        powers, streams = groups[-1] if groups else ([], 0)
        if groups and streams + r["streams"] <= size:
            groups[-1] = ([*powers, r["power"]], streams + r["streams"])
        else:
            groups.append(([r["power"]], r["streams"]))
    first, width, longest, total = {}, {}, {}, 0
    for powers, streams in groups:
        blocks = math.ceil(streams / size)
        for p in powers:
            first[p], width[p], longest[p] = total, blocks, powers[-1]
        total += blocks
    # squares below 2^(p+1) and 2^(q+1) can pass only if p + q + 2 > log2(t^2)
    needed = 2 * math.log2(threshold) - 2 - 1e-6 if threshold > 0 else -math.inf
    partner = {
        p: min((first[q] for q in first if longest[p] + longest[q] >= needed), default=total)
        for p in first
    }

    def of_power(values: dict[int, int]) -> Column:
        pairs = [F.lit(v) for item in values.items() for v in item]
        return F.element_at(F.create_map(*pairs), power)

    hashed = F.pmod(F.xxhash64("sid"), of_power(width)).cast("int")
    windows_at_most = sum(r["windows"] for r in counts)
    return of_power(first) + hashed, of_power(partner), total, windows_at_most, types


def _compare(
    sketches: DataFrame,
    family: HashFamily,
    threshold: int,
    per_function: bool,
    streams_per_block: int | None,
    kernel: type[SketchKernel] = SketchGridKernel,
) -> DataFrame:
    """The pairs above the threshold, as the rows of a ``kernel``."""
    own, partner, blocks, windows, types = _blocks(
        sketches, family, 0 if per_function else threshold, streams_per_block
    )
    candidates = sketches
    if threshold > 0 and not per_function:
        # A stream that cannot pass the threshold even with the longest stream
        # of its window, under some function, has no partner.
        squares = [f"square{f}" for f in range(family.depth)]
        longest = sketches.groupBy("window_end").agg(
            *(F.max(s).alias(f"max_{s}") for s in squares)
        )
        # one row per window; a window holds too many streams to be a join key
        if windows <= BROADCAST_ROWS:
            longest = F.broadcast(longest)
        floor = float(threshold) ** 2 * (1 - 1e-9)
        can_pass = F.lit(True)
        for s in squares:
            can_pass = can_pass & (F.col(s) * F.col(f"max_{s}") > floor)
        candidates = sketches.join(longest, "window_end").where(can_pass)
    names = [c for c in ("sid", "sids") if c in sketches.columns]
    lists = [F.col(c).cast(f"array<{t}>").alias(c) for c, t in zip(("cells", "counts"), types)]
    named = candidates.select("window_end", *names, *lists, own.alias("own"), partner.alias("partner"))
    rows = (
        named.where(F.col("partner") < blocks)
        .withColumns({"low": F.col("own"), "side": F.lit(0)})
        .withColumn(
            "high", F.explode(F.sequence(F.greatest("own", "partner"), F.lit(blocks - 1)))
        )
    )
    # a block meets itself where it is held: its rows are not sent a second time
    columns = (
        named.where("partner < own")
        .withColumns({"high": F.col("own"), "side": F.lit(1)})
        .withColumn("low", F.explode(F.sequence("partner", F.col("own") - 1)))
    )
    depth, buckets = family.depth, family.buckets
    number = F.col("high") * (F.col("high") + 1) / 2 + F.col("low")
    return run_tiles(
        rows.unionByName(columns).drop("own", "partner"),
        ["window_end", "low", "high"],
        "sid",
        lambda: kernel(depth, buckets, threshold, per_function),
        kernel.SCHEMA,
        max(1, windows) * blocks * (blocks + 1) // 2,
        F.xxhash64("window_end") % (1 << 30) + number.cast("bigint"),
    )


def list_pairs(lists: DataFrame, kind: str = WHOLE, *keys: str) -> DataFrame:
    """(keys, sid1, sid2, similarity), one row per pair, sid1 > sid2, of lists of pairs.

    Pairs are many and few are large: a small one is not made a decimal on its way to
    ``kind``.  What follows from the keys alone is worked out on the lists, before.
    """
    pairs = lists.select(*keys, "own", "small", "large", F.posexplode("other").alias("at", "partner"))
    small, large = (F.get(c, F.col("at")).cast(kind) for c in ("small", "large"))
    return pairs.select(
        *keys,
        F.greatest("own", "partner").alias("sid1"),
        F.least("own", "partner").alias("sid2"),
        F.coalesce(small, large).alias("similarity"),
    )


def grid_pairs(grids: DataFrame, kind: str, *keys: str) -> DataFrame:
    """As :func:`list_pairs`, of the rows of :class:`SketchGridKernel`."""
    values = ["few", "small", "large"]
    lines = grids.select(
        *keys, *values, "others", F.size("others").alias("width"), F.posexplode("owns").alias("line", "own")
    )
    begin = (F.col("line") * F.col("width")).alias("begin")
    pairs = lines.select(*keys, *values, begin, "own", F.posexplode("others").alias("at", "other"))
    at = F.col("begin") + F.col("at")
    # a large value is a pair's, and is looked at only where it is asked for
    marked = F.coalesce(F.get("few", at).cast("bigint"), F.get("small", at), F.lit(0))
    value = F.coalesce(*(F.get(c, at).cast(kind) for c in values), F.lit(-1).cast(kind))
    return pairs.where(marked >= 0).select(
        *keys,
        F.greatest("own", "other").alias("sid1"),
        F.least("own", "other").alias("sid2"),
        value.alias("similarity"),
    )


def class_pairs(classes: DataFrame, kind: str, *keys: str) -> DataFrame:
    """As :func:`list_pairs`, of the rows of :class:`SketchClassKernel`."""
    value = F.coalesce(*(F.col(c).cast(kind) for c in ("small", "large")))
    lines = classes.select(*keys, value.alias("similarity"), "others", F.explode("owns").alias("own"))
    pairs = lines.select(*keys, "similarity", "own", F.explode("others").alias("other"))
    return pairs.select(
        *keys,
        F.greatest("own", "other").alias("sid1"),
        F.least("own", "other").alias("sid2"),
        "similarity",
    )


def _all_pairs(
    cells: DataFrame,
    family: HashFamily,
    threshold: int,
    per_function: bool,
    streams_per_block: int | None,
    kind: str,
    *keys: str,
) -> DataFrame:
    sketches = build_sketches(cells, family, marked=True)
    merged = merge_equal(sketches)
    if merged is None:
        return grid_pairs(_compare(sketches, family, threshold, per_function, streams_per_block), kind, *keys)
    classes = _compare(merged, family, threshold, per_function, streams_per_block, SketchClassKernel)
    return class_pairs(classes, kind, *keys)


def inner_products(
    cells: DataFrame, family: HashFamily, streams_per_block: int | None = None, kind: str = WHOLE
) -> DataFrame:
    """(sid1, sid2, f, product), sid1 > sid2, where the product is not zero, as a ``kind``."""
    pairs = _all_pairs(cells, family, 0, True, streams_per_block, kind, "f")
    return pairs.select("sid1", "sid2", "f", F.col("similarity").alias("product"))


def sketch_similarity(
    cells: DataFrame,
    family: HashFamily,
    threshold: int = 0,
    streams_per_block: int | None = None,
    kind: str = WHOLE,
) -> DataFrame:
    """(sid1, sid2, similarity), sid1 > sid2, where it is above ``threshold``, as a ``kind``.

    A pair without a shared bucket under some function has similarity 0.
    """
    return _all_pairs(cells, family, threshold, False, streams_per_block, kind)


def window_similarity(
    cells: DataFrame,
    family: HashFamily,
    threshold: int = DEFAULT_THRESHOLD,
    streams_per_block: int | None = None,
    kind: str = WHOLE,
) -> DataFrame:
    """(window_end, sid1, sid2, similarity) from :func:`window_cells`."""
    lists = compare_windows(build_sketches(cells, family), family, threshold, streams_per_block)
    return list_pairs(lists, kind, "window_end")


def compare_windows(
    sketches: DataFrame,
    family: HashFamily,
    threshold: int = DEFAULT_THRESHOLD,
    streams_per_block: int | None = None,
) -> DataFrame:
    """As :func:`window_similarity`, from :func:`build_sketches`, in lists: give them to
    :func:`list_pairs`."""
    lists = _compare(sketches, family, threshold, False, streams_per_block, SketchListKernel)
    return lists.withColumn("window_end", F.timestamp_micros("window_end")).drop("f")
