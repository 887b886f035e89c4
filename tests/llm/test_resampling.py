"""Importance resampling against a plain version that hashes every run by itself."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidepair.llm import queries, resampling
from tidepair.llm.resampling import Shifts, bucket_counts, gains, resample, runs

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.01"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def buckets(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain(docs, items):
    """doc_id -> rows of (n_features, weight, score, rank) for (doc_id, text) rows."""
    found = [(i, buckets(t), len(words(t))) for i, t in docs]
    s, t = Counter(b for _, f, _ in found for b in f), Counter(b for x in items for b in buckets(x))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in s}
    rows = []
    for i, f, n in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    may = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(may[: 5 * len(may) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def test_query_against_plain_version(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    out = queries.op12_resampling(spark, SF)
    assert out.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in items.collect()])
    assert sum(r[4] is not None for r in want) > 30
    assert sorted(map(tuple, out.collect()), key=str) == want


def test_shifts_move_a_crc_past_any_length():
    move, rng = Shifts(), np.random.default_rng(3)
    for n in (0, 1, 7, 127, 128, 129, 1000, 65_537, 3_000_000):
        a, b = rng.bytes(50), rng.bytes(n)
        both = zlib.crc32(a + b) ^ int(move.by(np.array([zlib.crc32(a)], np.uint32), np.array([n]))[0])
        assert both == zlib.crc32(b)


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_runs_across_blocks(monkeypatch, rng, block):
    monkeypatch.setattr(resampling, "BLOCK_BYTES", block)
    texts = [*ODD_TEXTS, " ".join(rng.choice(["Foo", "bar", "é", "zz" * 40]) for _ in range(300)), "a", "b c", "d-E f"]
    found = {}
    for row, bucket in runs(texts):
        for r, b in zip(row.tolist(), bucket.tolist(), strict=True):
            found.setdefault(r, []).append(b)
    for i, text in enumerate(texts):
        assert sorted(found.get(i, [])) == sorted(buckets(text)), i


def test_odd_rows(spark, documents):
    long = "one two three four five six seven eight nine ten " * 3
    rows = [*enumerate(ODD_TEXTS), *((100 + i, f"{long} w{i % 7}") for i in range(60)), (None, long), (100, "x"), (100, long)]
    docs = documents(rows, ", rank string, _order int, n_words int", ("r", 1, 2))
    items = spark.createDataFrame([("one two three",), (None,)], "text string")
    out = resample(docs, items)
    assert [c for c in out.columns if c not in resampling.RESULTS] == ["doc_id", "lang", "source", "n_chars", "_order"]
    got = sorted(map(tuple, out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    assert got == plain(rows, ["one two three", None])
    for target in (items, items.limit(0)):
        assert resample(docs.limit(0), target).count() == 0
    none = gains(bucket_counts(docs), bucket_counts(items.limit(0)))
    assert (none <= math.floor(1000 * math.log((bucket_counts(docs).sum() + 10_000) / 10_000))).all()
    assert resample(docs, items.limit(0)).count() == len(rows)
    few = documents(rows[:5])  # no text of 20 words
    assert {r["rank"] for r in resample(few, items).collect()} == {None}
