from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tidepair.functions.hashing import LinearHashes
from tidepair.operators import tiles
from tidepair.operators.sketch import inner_products, sketch_similarity
from tidepair.operators.tiles import SketchListKernel
from tidepair.streaming.similarity import (
    read_pair_lists,
    read_pairs,
    read_progress,
    run_for,
    start_similarity,
)

DEPTH, BUCKETS = 3, 10


def _batch(rng, first, rows, scale):
    dense = rng.poisson(0.5, (rows, DEPTH * BUCKETS)) * scale
    cells = [np.flatnonzero(r) for r in dense]
    columns = {
        "sid": pa.array(np.arange(first, first + rows), pa.int64()),
        "cells": pa.array(cells, pa.list_(pa.int32())),
        "counts": pa.array([r[c] for r, c in zip(dense, cells)], pa.list_(pa.int64())),
    }
    return dense.reshape(rows, DEPTH, BUCKETS), pa.RecordBatch.from_pydict(columns)


def _pairs(batches):
    found = {}
    for r in (r for b in batches for r in b.to_pylist()):
        large = r["large"] or [None] * len(r["small"])
        assert r["window_end"] == 7 and len(r["other"]) == len(r["small"]) == len(large) > 0
        for other, small, digits in zip(r["other"], r["small"], large):
            key = max(r["own"], other), min(r["own"], other), r["f"]
            assert key not in found
            found[key] = int(small if digits is None else digits)
    return found


@pytest.mark.parametrize("scale", [1, 10**4, 10**9])
@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("per_function", [True, False])
@pytest.mark.parametrize("times", [-1, 0, 2, 4])
def test_pairs_in_lists(monkeypatch, scale, same, per_function, times):
    """A row for each streamed stream, not for each pair, whether few pairs pass or nearly all."""
    monkeypatch.setattr(SketchListKernel, "PART", 7)
    monkeypatch.setattr(tiles, "CHUNK", 6)
    monkeypatch.setattr(tiles, "FLUSH_ROWS", 10)
    rng = np.random.default_rng(3)
    held, held_batch = _batch(rng, 100, 30, scale)
    past, past_batch = (held, held_batch) if same else _batch(rng, 0, 20, scale)
    threshold = max(0, times) * scale * scale
    if times < 0:
        monkeypatch.setattr(SketchListKernel, "SPARSE", 0)  # every function pair by pair
    want = {}
    for i in range(len(held)):
        for j in range(len(past)):
            a, b = 100 + i, j + (100 if same else 0)
            products = [sum(int(x) * int(y) for x, y in zip(held[i, f], past[j, f])) for f in range(DEPTH)]
            if a > b and per_function:
                want |= {(a, b, f): p for f, p in enumerate(products) if p > 0}
            elif a > b and min(products) > threshold:
                want[a, b, 0] = min(products)
    kernel = SketchListKernel(DEPTH, BUCKETS, threshold, per_function)
    kernel.open((7, 0, 0 if same else 1))
    out = [*kernel.feed(0, held_batch), *kernel.feed(1, past_batch)]
    assert want and _pairs(out) == want
    assert all(b.num_rows == 1 or len(b.column("other").flatten()) <= 10 for b in out)


def test_whole_numbers_need_no_decimals(spark):
    family = LinearHashes(buckets=8)
    cells = spark.createDataFrame(
        [(s, f, 1, n) for s, n in ((1, 3), (2, 5), (3, 2**31)) for f in range(family.depth)],
        "sid bigint, f int, v int, n bigint",
    )
    for found in (
        sketch_similarity(cells, family, kind="bigint"),
        inner_products(cells, family, kind="bigint").where("f = 0").drop("f"),
    ):
        assert found.dtypes[2][1] == "bigint"
        assert {tuple(r) for r in found.collect()} == {(2, 1, 15), (3, 1, 3 * 2**31), (3, 2, 5 * 2**31)}
    hot = cells.withColumn("n", cells.n * 2**26)
    assert {tuple(r) for r in sketch_similarity(hot, family, kind="bigint").where("sid1 = 2").collect()} == {(2, 1, 15 * 2**52)}
    want = {(2, 1): 15 * 2**52, (3, 1): 3 * 2**83, (3, 2): 5 * 2**83}
    assert {(r.sid1, r.sid2): int(r.similarity) for r in sketch_similarity(hot, family).collect()} == want


def test_stream_keeps_its_pairs_as_lists(spark, tmp_path):
    """A row of the table of pairs has the partners of a stream, not one pair."""
    ts = "timestamp_micros(id * 1000000)"
    spark.range(600).selectExpr(f"{ts} AS ts", "id % 20 AS sid", "id % 2 AS item").write.parquet(f"{tmp_path}/in")
    feed = spark.readStream.schema("ts timestamp, sid bigint, item bigint").parquet(f"{tmp_path}/in")
    family, out = LinearHashes(buckets=8), f"{tmp_path}/out"
    seen = []
    run_for(
        start_similarity(
            feed, family, out, "120 seconds", "60 seconds", "1 second", 4, once=True,
            on_windows=lambda pairs, batch: seen.append(pairs.count()),
        )
    )
    lists, pairs = read_pair_lists(spark, out), read_pairs(spark, out)
    assert pairs.columns == ["window_end", "sid1", "sid2", "similarity"]
    progress = {r.window_end: r.pairs for r in read_progress(spark, out).collect()}
    found = {r.window_end: r["count"] for r in pairs.groupBy("window_end").count().collect()}
    assert found and found == {w: n for w, n in progress.items() if n} and sum(seen) == pairs.count()
    assert 2 * lists.count() < pairs.count() == pairs.dropDuplicates(["window_end", "sid1", "sid2"]).count()
    assert pairs.where("sid1 <= sid2").count() == 0
