from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepair.functions.hashing import LinearHashes
from tidepair.operators import sketch
from tidepair.operators.sketch import build_sketches, compare_windows, inner_products, sketch_similarity
from tidepair.operators.tiles import SketchGridKernel, SketchListKernel

FAMILY = LinearHashes(buckets=70)


def cells(spark, counts):
    """One cell of each function and stream, in one bucket."""
    rows = [(sid, f, 3, n) for sid, n in counts.items() for f in range(FAMILY.depth)]
    return spark.createDataFrame(rows, "sid bigint, f int, v int, n bigint")


@pytest.mark.parametrize("most, kind", [(126, "tinyint"), (128, "smallint"), (32768, "int"), (2**31, "bigint")])
def test_streams_are_sent_once_for_each_block_in_few_bytes(spark, monkeypatch, most, kind):
    sent = []
    run = sketch.run_tiles
    monkeypatch.setattr(sketch, "run_tiles", lambda rows, *rest: sent.append(rows) or run(rows, *rest))
    counts = {sid: max(1, most - sid) for sid in range(20)}
    found = sketch_similarity(cells(spark, counts), FAMILY, 0, 4)
    want = {(a, b): counts[a] * counts[b] for a in counts for b in counts if a > b}
    assert {(r[0], r[1]): int(r[2]) for r in found.collect()} == want
    types = dict(sent[0].dtypes)
    assert (types["cells"], types["counts"]) == ("array<smallint>", f"array<{kind}>")
    # of a block with itself there is one copy, not one for each side
    assert sent[0].where("side = 1 AND low = high").count() == 0
    blocks = sent[0].agg(F.max("high")).first()[0] + 1
    assert blocks > 1 and sent[0].count() <= len(counts) * blocks


def test_counts_on_both_sides_of_a_type(spark):
    counts = {1: 127, 2: 128, 3: 1, 4: 32767, 5: 32768, 6: 2**31}
    found = inner_products(cells(spark, counts), FAMILY)
    want = {(a, b, f): counts[a] * counts[b] for a in counts for b in counts if a > b for f in range(FAMILY.depth)}
    assert {tuple(r)[:3]: int(r["product"]) for r in found.collect()} == want


@pytest.mark.parametrize("kernel", [SketchListKernel, SketchGridKernel])
def test_a_held_block_meets_itself_at_its_end(kernel):
    rng = np.random.default_rng(4)
    dense = rng.poisson(1.0, (30, 2, 6)).astype(np.int64)
    batch = pa.RecordBatch.from_pydict(
        {
            "sid": pa.array(np.arange(30), pa.int64()),
            "cells": pa.array([np.flatnonzero(r) for r in dense.reshape(30, 12)], pa.list_(pa.int16())),
            "counts": pa.array([r[r > 0] for r in dense.reshape(30, 12)], pa.list_(pa.int8())),
        }
    )
    state = kernel(2, 6, 2, False)
    found = []
    for tile, rows in (((0, 0, 0), 30), ((1, 1, 1), 10), ((1, 0, 1), 10)):
        state.open(tile)
        assert not list(state.feed(0, batch.slice(0, rows)))
        found.append(0)
        for out in state.close():
            sizes = [
                len(v) for row in out.to_pylist() for v in (row.get("few"), row.get("small")) if v is not None
            ]
            found[-1] += sum(sizes)
    least = np.einsum("ifv,jfv->fij", dense, dense).min(axis=0)
    want = [sum(least[i, j] > 2 for i, j in itertools.combinations(range(n), 2)) for n in (30, 10)]
    if kernel is SketchListKernel:
        assert found == [*want, 0]
    else:  # a grid has places that are no pair
        assert found[0] >= want[0] and found[1] >= want[1] and found[2] == 0


def test_windows_of_a_stream_in_many_blocks(spark):
    """The same lists whatever the number of blocks."""
    rows = [(w, s, f, (s * 3 + w + f) % 7, 1 + (s + w) % 3) for w in range(3) for s in range(12) for f in range(5)]
    table = spark.createDataFrame(rows, "w int, sid bigint, f int, v int, n bigint").select(
        F.struct(F.timestamp_seconds("w").alias("start"), F.timestamp_seconds(F.col("w") + 1).alias("end")).alias("window"),
        "sid", "f", "v", "n", F.col("n").alias("fresh"),
    )
    seen = []
    for size in (None, 1, 5):
        lists = compare_windows(build_sketches(table, FAMILY), FAMILY, 1, size)
        seen.append({tuple(map(str, r)) for r in sketch.list_pairs(lists, "bigint", "window_end").collect()})
    assert seen[0] and seen[0] == seen[1] == seen[2]
