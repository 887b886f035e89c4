"""Best matches by bounds: equal to the sort of all scores, with few of them worked out."""

from __future__ import annotations

import random
from datetime import date, timedelta
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tidepair.operators.bounds import BoundedTopKernel
from tidepair.operators.cosine import cosine_aligned, top_matches
from tidepair.operators.topk import top_k

FIRST = date(2024, 1, 1)
MEASURES = ("mean", "min", "max")


def panel(spark, kind, named, value):
    rows = [(n, FIRST + timedelta(d), float(v)) for n, vs in named.items() for d, v in enumerate(vs) if v is not None]
    return spark.createDataFrame(rows, f"{kind} string, date date, {value} double")


def drawn(rng, count, days, prefix, bursts=3):
    """Mostly quiet series with some busy days, zeros among them."""
    out = {}
    for i in range(count):
        values = [rng.choice((0.0, 0.1, 0.2)) for _ in range(days)]
        for _ in range(bursts):
            values[rng.randrange(days)] = rng.uniform(3, 9)
        out[f"{prefix}{i}"] = values
    return out


def matrix_batch(names, rows):
    days = np.arange(len(rows[0]))
    lists = pa.array([days.tolist()] * len(rows), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [pa.array(names), lists, pa.array([list(map(float, r)) for r in rows], pa.list_(pa.float64()))],
        names=["name", "days", "vals"],
    )


@pytest.mark.parametrize("block", [3, 7, None])
def test_best_of_several_blocks(spark, block):
    rng = random.Random(1)
    series, visits = drawn(rng, 30, 25, "s"), drawn(rng, 20, 25, "t")
    visits["t3"] = visits["t4"] = [0.0] * 24 + [5.0]  # equal topics, ties
    series["s1"] = [0.0] * 25
    x, v = panel(spark, "series", series, "value"), panel(spark, "topic", visits, "visit")
    every = cosine_aligned(x, v).cache()
    for k in (1, 20):
        found = top_matches(x, v, k, MEASURES, 6, block)
        for m in MEASURES:
            assert top_k(found, m, k, 6).collect() == top_k(every, m, k, 6).collect()
    every.unpersist()


def test_most_pairs_are_never_scored():
    rng = random.Random(2)
    topics, series = drawn(rng, 60, 40, "t", 2), drawn(rng, 300, 40, "s", 2)
    kernel = BoundedTopKernel(20, MEASURES, 1e-6)
    kernel.open((0, 0, 0))
    assert not list(kernel.feed(1, matrix_batch(list(topics), list(topics.values()))))
    out = list(kernel.feed(2, matrix_batch(list(series), list(series.values()))))
    rows = pa.Table.from_batches(out).to_pylist()
    assert kernel.possible == 3 * 300 * 60 * 59 // 2
    assert 0 < kernel.scored < 0.1 * kernel.possible
    t = {n: np.array(v) for n, v in topics.items()}
    for m, of in zip(MEASURES, (lambda a, b: (a + b) / 2, np.minimum, np.maximum), strict=True):
        best = sorted(
            (
                float(x @ y / np.sqrt((x @ x) * (y @ y)))
                for a, b in combinations(t.values(), 2)
                for y in [of(a, b)]
                for x in map(np.array, series.values())
            ),
            reverse=True,
        )[:20]
        got = sorted((r["similarity"] for r in rows if r["measure"] == m), reverse=True)[:20]
        assert np.allclose(best, got, atol=1e-9)


def test_bounds_hold_for_every_pair():
    rng = np.random.default_rng(5)
    for scale in (1.0, 1e6):
        topics = np.abs(rng.normal(size=(12, 9))) * scale * (rng.random((12, 9)) < 0.6)
        series = np.abs(rng.normal(size=(40, 9)))
        kernel = BoundedTopKernel(1, MEASURES, 0.0)
        kernel.open((0, 0, 0))
        list(kernel.feed(1, matrix_batch([f"t{i}" for i in range(12)], topics)))
        kernel._prepare()
        norm = np.sqrt((series**2).sum(axis=1))
        for m in MEASURES:
            left, right = ((series / norm[:, None]) @ x.T for x in (kernel.left[kernel.a], kernel.right[kernel.b]))
            share = np.minimum(left, right) if m == "min" else left + right
            with np.errstate(invalid="ignore"):
                bound = np.nan_to_num(share * kernel.over[m], nan=1.0, posinf=1.0) + 1e-9
            for pair in range(len(kernel.a)):
                score = kernel._exact(m, series, norm, np.full(40, pair))
                known = ~np.isnan(score)
                assert (np.minimum(bound[known, pair], 1 + 1e-9) >= score[known] - 1e-9).all()


def test_holes_and_negative_values_are_scored_as_before(spark):
    rng = random.Random(3)
    series, visits = drawn(rng, 12, 10, "s"), drawn(rng, 8, 10, "t")
    visits["t2"][4] = None
    series["s5"][1] = None
    series["s6"][2] = -4.0
    x, v = panel(spark, "series", series, "value"), panel(spark, "topic", visits, "visit")
    for some in (v, v.where("topic <> 't2'")):
        every, found = cosine_aligned(x, some), top_matches(x, some, 5, MEASURES, 6, 3)
        for m in MEASURES:
            assert top_k(found, m, 5, 6).collect() == top_k(every, m, 5, 6).collect()
