from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepair.functions.hashing import LinearHashes
from tidepair.operators import sketch, tiles
from tidepair.operators.sketch import _compare, build_sketches, inner_products, merge_equal, sketch_similarity
from tidepair.operators.tiles import SketchClassKernel

DEPTH, BUCKETS = 3, 10


def _batch(rng, first, sizes, scale):
    """Rows of so many streams each, their names dealt in turn."""
    dense = rng.poisson(0.5, (len(sizes), DEPTH * BUCKETS)) * scale
    cells = [np.flatnonzero(r) for r in dense]
    names = rng.permutation(first + np.arange(sum(sizes)))
    sids = [np.sort(s) for s in np.split(names, np.cumsum(sizes)[:-1])]
    order = np.argsort([s[0] for s in sids])
    columns = {
        "sid": pa.array([sids[k][0] for k in order], pa.int64()),
        "sids": pa.array([sids[k] for k in order], pa.list_(pa.int64())),
        "cells": pa.array([cells[k] for k in order], pa.list_(pa.int32())),
        "counts": pa.array([dense[k][cells[k]] for k in order], pa.list_(pa.int64())),
    }
    streams = {int(s): row.reshape(DEPTH, BUCKETS) for row, names in zip(dense, sids) for s in names}
    return streams, pa.RecordBatch.from_pydict(columns)


def _pairs(batches):
    found = {}
    for r in (r for b in batches for r in b.to_pylist()):
        (value,) = (r[c] for c in ("small", "large") if r[c] is not None)
        assert r["window_end"] == 7 and r["owns"] and r["others"]
        for own in r["owns"]:
            for other in r["others"]:
                key = max(own, other), min(own, other), r["f"]
                assert own != other and key not in found
                found[key] = int(value)
    return found


@pytest.mark.parametrize("scale", [1, 10**4, 10**9, 10**15])
@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("per_function", [True, False])
@pytest.mark.parametrize("times", [-1, 0, 2])
def test_pairs_of_classes(monkeypatch, scale, same, per_function, times):
    """Rows of one stream, of as many as a cut and of more, with others and with themselves."""
    for name, value in (("PART", 4), ("OWNS", 2), ("OTHERS", 3)):
        monkeypatch.setattr(SketchClassKernel, name, value)
    monkeypatch.setattr(tiles, "CHUNK", 5)
    monkeypatch.setattr(tiles, "FLUSH_ROWS", 10)
    rng = np.random.default_rng(3)
    held, held_batch = _batch(rng, 100, [1, 2, 3, 7, 1, 4, 6, 1, 2], scale)
    past, past_batch = (held, held_batch) if same else _batch(rng, 0, [5, 1, 1, 8, 2, 3], scale)
    threshold = max(0, times) * scale * scale
    if times < 0:
        monkeypatch.setattr(SketchClassKernel, "SPARSE", 0)  # every function pair by pair
    want = {}
    for a, x in held.items():
        for b, y in past.items():
            products = [sum(int(m) * int(n) for m, n in zip(x[f], y[f])) for f in range(DEPTH)]
            if a > b and per_function:
                want |= {(a, b, f): p for f, p in enumerate(products) if p > 0}
            elif a > b and min(products) > threshold:
                want[a, b, 0] = min(products)
    kernel = SketchClassKernel(DEPTH, BUCKETS, threshold, per_function)
    kernel.open((7, 0, 0 if same else 1))
    out = [*kernel.feed(0, held_batch), *kernel.feed(1, past_batch)]
    assert want and _pairs(out) == want


def test_copies_take_less_than_a_byte_a_pair():
    rng = np.random.default_rng(3)
    batches = [_batch(rng, first, [200] * 10, 1)[1] for first in (0, 10000)]
    kernel = SketchClassKernel(DEPTH, BUCKETS, 0, False)
    kernel.open((7, 0, 1))
    out = [*kernel.feed(0, batches[0]), *kernel.feed(1, batches[1])]
    pairs = len(_pairs(out))
    assert pairs and sum(b.nbytes for b in out) < pairs


def _cells(spark, streams, kinds):
    """Streams of equal cells where their numbers agree modulo ``kinds``."""
    rows = [
        (s, f, v, (s % kinds + f + v) % 5 + 1)
        for s in range(streams) for f in range(5) for v in range(8) if (s % kinds + (f % 2 + 1) * v) % 3
    ]
    return rows, spark.createDataFrame(rows, "sid bigint, f int, v int, n bigint")


def test_equal_sketches_are_compared_once(spark):
    family = LinearHashes(buckets=8)
    _, table = _cells(spark, 120, 6)
    merged = merge_equal(build_sketches(table, family, marked=True))
    assert [r.sids for r in merged.orderBy("sid").collect()] == [list(range(k, 120, 6)) for k in range(6)]
    rows = _compare(merged, family, 0, False, None, SketchClassKernel)
    few = rows.where(F.size("owns") > 1)
    assert few.agg(F.sum(F.size("owns") * F.size("others"))).first()[0] == 15 * 20 * 20
    assert few.count() == 15
    _, unlike = _cells(spark, 12, 6)
    assert merge_equal(build_sketches(unlike, family, marked=True)) is None


@pytest.mark.parametrize("most", [None, 10])
def test_queries_agree_with_plain_sums(spark, monkeypatch, most):
    """All streams of a sketch in one row, or in several."""
    if most:
        monkeypatch.setattr(sketch, "CLASS_STREAMS", most)
    family = LinearHashes(buckets=8)
    rows, table = _cells(spark, 100, 6)
    cells = {r[:3]: r[3] for r in rows}
    if most:
        merged = merge_equal(build_sketches(table, family, marked=True))
        assert merged.count() > 12 and merged.selectExpr("explode(sids) AS s").distinct().count() == 100
    products = {
        (a, b, f): sum(cells.get((a, f, v), 0) * cells.get((b, f, v), 0) for v in range(8))
        for a in range(100) for b in range(a) for f in range(5)
    }
    least = {(a, b): min(products[a, b, f] for f in range(5)) for a, b, _ in products}
    middle = sorted(least.values())[len(least) // 2]
    for threshold, size in ((0, None), (middle, None), (middle, 3)):
        for kind in ("bigint", "decimal(38,0)"):
            found = sketch_similarity(table, family, threshold, size, kind)
            pairs = found.collect()
            assert found.dtypes[2][1] == kind and len(pairs) == len(set(pairs))
            assert {(r[0], r[1]): int(r[2]) for r in pairs} == {k: p for k, p in least.items() if p > threshold}
    pairs = inner_products(table, family, kind="bigint").collect()
    assert {tuple(r) for r in pairs} == {(*k, p) for k, p in products.items() if p > 0}
