from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidepair.functions.hashing import (
    DEFAULT_BUCKETS,
    DEFAULT_THRESHOLD,
    MERSENNE_PRIME_31,
    LinearHashes,
    Murmur3XorHashes,
)
from tidepair.operators.sketch import (
    inner_products,
    pane_cells,
    sketch_cells,
    sketch_similarity,
    window_cells,
    window_similarity,
)

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def feed(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp, sid long, item long")


def random_rows(rng, streams, events, items, span_hours=48):
    return [
        (
            START + timedelta(seconds=rng.randrange(span_hours * 3600)),
            rng.randrange(streams) - 3,
            rng.randrange(items) - items // 2,
        )
        for _ in range(events)
    ]


def bucket(family, item, f):
    x = item % MERSENNE_PRIME_31
    return (family.multipliers[f] * x + family.offsets[f]) % MERSENNE_PRIME_31 % family.buckets


def brute_products(family, rows):
    cells = [Counter() for _ in range(family.depth)]
    for _, s, x in rows:
        for f in range(family.depth):
            cells[f][s, bucket(family, x, f)] += 1
    streams = {s for _, s, _ in rows}
    return {
        (i, j, f): sum(cells[f][i, v] * cells[f][j, v] for v in range(family.buckets))
        for i in streams
        for j in streams
        if i > j
        for f in range(family.depth)
    }


def brute_similarity(family, rows, threshold=0):
    products, result = brute_products(family, rows), {}
    for (i, j, _), p in products.items():
        result[i, j] = min(p, result.get((i, j), p))
    return {k: v for k, v in result.items() if v > threshold}


def exact(rows):
    counts = Counter((s, x) for _, s, x in rows)
    streams, items = {s for _, s, _ in rows}, {x for _, _, x in rows}
    return {
        (i, j): sum(counts[i, x] * counts[j, x] for x in items)
        for i in streams
        for j in streams
        if i > j
    }


def pairs(df):
    rows = df.collect()
    got = {(r.sid1, r.sid2): r.similarity for r in rows}
    assert len(got) == len(rows)
    return got


def test_defaults():
    assert LinearHashes().depth == 5 and LinearHashes().buckets == DEFAULT_BUCKETS == 3000
    assert DEFAULT_THRESHOLD == 3000


@pytest.mark.parametrize("block", [None, 1, 3, 100])
@pytest.mark.parametrize("threshold", [0, 12, 60, 10_000])
def test_similarity_is_the_least_inner_product(spark, block, threshold):
    rng = random.Random(11)
    family = LinearHashes(buckets=13)
    # streams of very different size, so that blocks are pruned by norm
    rows = random_rows(rng, 12, 400, 30) + [
        (START, 50 + s, rng.randrange(30)) for s in range(6) for _ in range(4**s // 4)
    ]
    cells = sketch_cells(feed(spark, rows), family)
    got = pairs(sketch_similarity(cells, family, threshold, block))
    assert got == brute_similarity(family, rows, threshold)


@pytest.mark.parametrize("block", [None, 4])
def test_inner_products_per_function(spark, block):
    rows = random_rows(random.Random(12), 9, 60, 40)
    family = LinearHashes(buckets=17)
    got = inner_products(sketch_cells(feed(spark, rows), family), family, block).collect()
    want = {k: v for k, v in brute_products(family, rows).items() if v > 0}
    assert {(r.sid1, r.sid2, r.f): r.product for r in got} == want and len(got) == len(want)


def test_estimate_is_never_below_the_exact_product(spark):
    rows = random_rows(random.Random(13), 15, 800, 60)
    truth = exact(rows)
    for family in (LinearHashes(buckets=7), LinearHashes(buckets=1000), Murmur3XorHashes(buckets=31)):
        got = pairs(sketch_similarity(sketch_cells(feed(spark, rows), family), family))
        assert all(got.get(k, 0) >= v for k, v in truth.items())
    wide = LinearHashes(buckets=100_003)
    got = pairs(sketch_similarity(sketch_cells(feed(spark, rows), wide), wide))
    assert got == {k: v for k, v in truth.items() if v}


def test_pair_that_shares_no_bucket_under_one_function_is_not_similar(spark):
    family = LinearHashes(buckets=5)
    a = 0
    b = next(
        x
        for x in range(1, 1000)
        if 0 < sum(bucket(family, a, f) == bucket(family, x, f) for f in range(5)) < 5
    )
    cells = sketch_cells(feed(spark, [(START, 1, a), (START, 2, b)]), family)
    assert inner_products(cells, family).count() > 0
    assert sketch_similarity(cells, family).count() == 0


def test_hot_item_and_hot_stream(spark):
    """A third of all rows on one item, and a third in one stream."""
    family = LinearHashes(buckets=64)
    hot_item = spark.range(30_000).selectExpr("id % 300 AS sid", "7L AS item")
    hot_stream = spark.range(30_000).selectExpr("-1L AS sid", "id % 500 AS item")
    rest = spark.range(30_000).selectExpr("id % 300 AS sid", "1000 + id % 977 AS item")
    rows = hot_item.unionAll(hot_stream).unionAll(rest).withColumn("ts", F.lit(START))
    got = pairs(sketch_similarity(sketch_cells(rows, family), family, 9_000))
    # every stream took the hot item 100 times, so every pair passes
    assert len(got) == 301 * 300 // 2
    assert all(v > 9_000 for v in got.values())


def test_large_counts_stay_exact(spark):
    """Products beyond 2^53 and beyond 2^63 are exact."""
    family = LinearHashes(buckets=3)
    schema = "sid long, f int, v int, n long"
    for big in ((1 << 29) + 1, (1 << 32) + 1, (1 << 60) + 7):
        cells = spark.createDataFrame([(s, f, 1, big) for s in (1, 2) for f in range(5)], schema)
        assert pairs(sketch_similarity(cells, family)) == {(2, 1): big * big}
        assert pairs(sketch_similarity(cells, family, big * big - 1)) == {(2, 1): big * big}
        assert pairs(sketch_similarity(cells, family, big * big)) == {}
        assert {r.product for r in inner_products(cells, family).collect()} == {big * big}


def test_hot_stream_beside_light_ones(spark):
    """Its product with itself passes 2^63, but is none of the results."""
    family = LinearHashes(buckets=3)
    counts = {1: 4_000_000_000, 2: 5, 3: 1}
    cells = spark.createDataFrame(
        [(s, f, 1, n) for s, n in counts.items() for f in range(5)], "sid int, f int, v int, n long"
    )
    want = {(2, 1): 20_000_000_000, (3, 1): 4_000_000_000, (3, 2): 5}
    assert pairs(sketch_similarity(cells, family)) == want


def test_int_ids(spark):
    family = LinearHashes(buckets=7)
    rows = spark.createDataFrame([(START, i % 3, i % 2) for i in range(12)], "ts timestamp, sid int, item int")
    assert len(pairs(sketch_similarity(sketch_cells(rows, family), family))) == 3


def test_null_and_empty_input(spark):
    family = LinearHashes(buckets=5)
    rows = [(START, None, 1), (START, 1, None)]
    cells = sketch_cells(feed(spark, rows), family)
    assert cells.count() == 0
    assert sketch_similarity(cells, family).count() == 0
    assert inner_products(cells, family).count() == 0


@pytest.mark.parametrize("threshold", [0, 6])
def test_windows(spark, threshold):
    rng = random.Random(14)
    family = LinearHashes(buckets=11)
    rows = random_rows(rng, 8, 300, 20)
    cells = window_cells(pane_cells(feed(spark, rows), family, "3 hours"), "12 hours", "3 hours")
    got = {
        (r.end, r.sid1, r.sid2): r.similarity
        for r in window_similarity(cells, family, threshold)
        .withColumn("end", F.unix_seconds("window_end"))
        .collect()
    }
    want = {}
    for k in range(1, 48 // 3 + 4):
        end = START + timedelta(hours=3 * k)
        inside = [r for r in rows if end - timedelta(hours=12) <= r[0] < end]
        for (i, j), v in brute_similarity(family, inside, threshold).items():
            want[int(end.timestamp()), i, j] = v
    assert got == want
    fresh = cells.where("f = 0").agg(F.sum("fresh")).first()[0]
    assert fresh == len(rows)
