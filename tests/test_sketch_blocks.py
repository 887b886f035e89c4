from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepair.functions.hashing import LinearHashes
from tidepair.operators.sketch import _blocks
from tidepair.operators.tiles import SketchKernel

DEPTH, BUCKETS = 3, 10


def test_streams_of_few_cells_are_copied_to_few_blocks(spark):
    """A block is bounded by the cells that streams have, not by the width of the sketch."""
    sketches = spark.range(20_000).select(
        F.lit(0).cast("bigint").alias("window_end"),
        F.col("id").alias("sid"),
        F.array(*(F.lit(f * 3000) for f in range(5))).alias("cells"),
        F.lit(4.0).alias("square0"),
    )
    assert _blocks(sketches, LinearHashes(buckets=3000), 1, None)[2] <= 4


def _batch(rng, first, rows, scale):
    dense = rng.poisson(0.5, (rows, DEPTH * BUCKETS)) * scale
    cells = [np.flatnonzero(r) for r in dense]
    counts = [r[c] for r, c in zip(dense, cells)]
    batch = pa.RecordBatch.from_pydict(
        {
            "sid": pa.array(np.arange(first, first + rows), pa.int64()),
            "cells": pa.array(cells, pa.list_(pa.int32())),
            "counts": pa.array(counts, pa.list_(pa.int64())),
        }
    )
    return dense.reshape(rows, DEPTH, BUCKETS), batch


@pytest.mark.parametrize("scale", [1, 10**4, 10**9])
@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("keep", [0, 1 << 20])
def test_parts_of_held_rows(monkeypatch, scale, same, keep):
    """In single and double precision and in whole numbers, with held parts kept or made again."""
    monkeypatch.setattr(SketchKernel, "PART", 7)
    monkeypatch.setattr(SketchKernel, "KEEP_BYTES", keep)
    monkeypatch.setattr("tidepair.operators.tiles.CHUNK", 6)
    rng = np.random.default_rng(3)
    held, held_batch = _batch(rng, 100, 30, scale)
    past, past_batch = (held, held_batch) if same else _batch(rng, 0, 20, scale)
    threshold = 4 * scale * scale
    want = {}
    for i in range(len(held)):
        for j in range(len(past)):
            least = min(sum(int(x) * int(y) for x, y in zip(held[i, f], past[j, f])) for f in range(DEPTH))
            a, b = 100 + i, j + (100 if same else 0)
            if a > b and least > threshold:
                want[a, b] = least
    kernel = SketchKernel(DEPTH, BUCKETS, threshold, False)
    kernel.open((0, 0, 0 if same else 1))
    out = [*kernel.feed(0, held_batch.slice(0, 11)), *kernel.feed(0, held_batch.slice(11))]
    for at in range(0, past_batch.num_rows, 9):
        out += kernel.feed(1, past_batch.slice(at, 9))
    rows = [r for b in out for r in b.to_pylist()]
    found = {(r["sid1"], r["sid2"]): int(r["small"] if r["large"] is None else r["large"]) for r in rows}
    assert want and len(rows) == len(found) and found == want
