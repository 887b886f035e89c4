"""Vector codes against plain loops over Python integers; what moves and what stays."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from tests.compare import connect, same
from tidepair.llm import queries, vector_codes
from tidepair.llm.vector_codes import Deal, _first_deal, _migrated, compress, train, usable

SMALL = "/root/testdata/sf0.001"

TABLE = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """(vec_id, code, error, label_error, sha) of (vec_id, vector, label) rows."""
    good = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not good:
        return []
    width = len(good[0][1])
    good = [r for r in good if len(r[1]) == width]
    cut = [(p * width // 8, (p + 1) * width // 8) for p in range(8)]
    whole = [[int(np.floor(np.float32(c).astype(float) * 4096)) for c in r[1]] for r in good]
    parts = [[w[a:b] for a, b in cut] for w in whole]
    books = [[list(v[p]) for v in parts[:16]] for p in range(8)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(6):
        for p in range(8):
            members = defaultdict(list)
            for v in parts:
                members[nearest(v[p], books[p])[1]].append(v[p])
            for j, of in members.items():
                books[p][j] = [sum(c) // len(of) for c in zip(*of, strict=True)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found = [[nearest(v[p], books[p]) for p in range(8)] for v in parts]
    errors = [sum(d for d, _ in f) for f in found]
    of_label = defaultdict(int)
    for r, e in zip(good, errors, strict=True):
        of_label[r[2]] += e
    return [
        (r[0], "".join(f"{j:02x}" for _, j in f), e, of_label[r[2]], sha)
        for r, f, e in zip(good, found, errors, strict=True)
    ]


def vectors(n, width, seed, scale=0.3):
    rng = random.Random(seed)
    return [[float(np.float32(rng.gauss(0, scale))) for _ in range(width)] for _ in range(n)]


def ours(frame):
    return sorted(map(tuple, compress(frame).collect()), key=str)


def test_sql_on_the_smallest_tables(spark):
    ok, what = same(queries.op11_vector_codes(spark, SMALL), connect(SMALL), queries.ORACLES["op11_vector_codes"])
    assert ok, what


@pytest.mark.parametrize("width,owner_rows", [(16, 4096), (13, 7), (3, 5)])
def test_against_plain_loops(spark, monkeypatch, width, owner_rows):
    monkeypatch.setattr(vector_codes, "OWNER_ROWS", owner_rows)
    some = vectors(150, width, 5)
    rows = [(i, v, i % 4 if i % 5 else None) for i, v in enumerate(some)]
    rows += [(200 + i, some[3], 1) for i in range(90)]  # a hot vector
    frame = spark.createDataFrame(rows, TABLE).repartition(5)
    assert ours(frame) == sorted(plain(rows), key=str)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = vectors(20, 8, 9)
    rows = [
        (5, None, 1), (6, [], 1), (7, [None] * 8, 1), (8, [nan] + [0.0] * 7, 1), (9, [0.0] * 7 + [-inf], 2),
        (10, [0.0] * 8, None), (10, [-0.5] * 8, None), (10, [0.0] * 8, None), (None, good[0], 3), (1000, [1.0] * 9, 4),
        *((20 + i, v, i % 2) for i, v in enumerate(good)), (11, [1e9, -1e9, 1e12, 0.0, 0.0, 0.0, 0.0, 3e7], 5),
    ]
    assert ours(spark.createDataFrame(rows, TABLE)) == sorted(plain(rows), key=str)
    extra = spark.createDataFrame([(*r, 1, "x") for r in rows], TABLE + ", error int, code string")
    assert ours(extra) == sorted(plain(rows), key=str)
    for some in (rows[:5], [], rows[5:7]):
        frame = spark.createDataFrame(some, TABLE)
        assert ours(frame) == sorted(plain(some), key=str)
    huge = spark.createDataFrame([(1, [0.0] * 8, 1), (2, [3e38] * 8, 1)] + [(3 + i, [0.0] * 8, 1) for i in range(20)], TABLE)
    assert {r["error"] for r in compress(huge).collect()} <= {0, None}


def test_only_parts_that_change_entry_move(spark):
    frame = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors(400, 16, 2))], TABLE)
    good = usable(frame, "embedding")
    books, width = train(good)
    again = [b.copy() for b in books]
    deal, n = Deal(3), 4
    x = np.array([r["embedding"] for r in good.collect()])
    blocks = spark.sparkContext.parallelize([{"vectors": x[i : i + 50].tobytes()} for i in range(0, 400, 50)], 4)
    first = _first_deal(blocks, books, deal, width, n).persist()
    again[2][0] = [c + 30 for c in again[2][0]]
    then = _migrated(first, again, deal, n)
    assert then.getNumPartitions() == n and then.partitioner == first.partitioner  # the union is narrow

    def members(rdd):
        out = defaultdict(list)
        for part, found in enumerate(rdd.glom().collect()):
            for owner, some in found:
                assert owner % n == part
                out[owner] += map(tuple, some.tolist())
        return {k: sorted(v) for k, v in out.items()}

    before, after = members(first), members(then)
    assert sum(map(len, before.values())) == sum(map(len, after.values())) == 400 * 8
    for owner in before.keys() | after.keys():
        if deal.place(owner)[0] != 2:
            assert before.get(owner) == after.get(owner)
    one = _migrated(first, books, deal, n)
    lineage = one.toDebugString().decode()
    assert lineage.count("PartitionerAwareUnionRDD") == 1
    assert members(one) == before  # the same codebooks move nothing
    first.unpersist()
