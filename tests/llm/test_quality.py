"""Quality from positives and unlabelled text: numbers, risk and prior against plain versions,
accuracy on rows that were not learned from, odd rows."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepair.llm import quality, queries
from tidepair.llm.quality import WIDTH, described, estimated_prior, fit, risk, score_quality, trusted, with_numbers
from tidepair.llm.textbytes import chunks

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def kind(b):
    for k, some in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", None, "0123456789", " ", "\t\n\v\f\r", ".,;:'-?\"()")):
        if some is None:
            if b >= 0x80:
                return k
        elif chr(b) in some:
            return k
    return 7


def plain_numbers(text):
    data = (text or "").encode()
    out = [0.0] * 64
    for a, b in zip(data, data[1:], strict=False):
        out[8 * kind(a) + kind(b)] += 1
    out = [math.sqrt(n / max(1, len(data) - 1)) for n in out]
    low = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in data)
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    lines = [x for x in low.split(b"\n") if x]
    n, three = len(words), list(zip(words, words[1:], words[2:], strict=False))
    return [
        *out, math.log1p(n) / 10, len(set(words)) / max(1, n), len(set(three)) / max(1, len(three)),
        max(map(words.count, set(words))) / n if n else 0, len(set(lines)) / max(1, len(lines)),
        min(1, 5 * len(lines) / max(1, n)), min(20, len(data) / max(1, n)) / 10, n < 50, n < 10, n == 0, 1,
    ]


def test_numbers_against_plain_version():
    texts = [*ODD_TEXTS, "A b\na b\n\nA  B c c c", "x|y | z!! 12,5 é", "one two three one two three"]
    want = np.array([plain_numbers(t) for t in texts])
    for limit in (1 << 20, 10):
        found = np.vstack([described(c) for c in chunks(pa.array(texts, pa.string()), limit)])
        assert np.allclose(found, want, atol=1e-12)


@pytest.fixture(scope="module")
def mixed(spark):
    """Rows of two kinds, a share of 0.7 good, some of them known; as a table and as arrays."""
    rng = np.random.default_rng(4)
    n = 3000
    good = rng.random(n) < 0.7
    x = np.zeros((n, WIDTH))
    x[:, :6] = rng.normal(np.where(good, 1.0, -1.0)[:, None], 1, (n, 6))
    x[:, -1] = 1
    x = x.astype(np.float32).astype(float)
    known = good & (rng.random(n) < 0.5)
    rows = [(a.tolist(), bool(k)) for a, k in zip(x, known, strict=True)]
    table = spark.createDataFrame(rows, "_x array<float>, _good boolean").repartition(5).cache()
    yield table, x, known, good
    table.unpersist()


def test_risk_is_the_unbiased_one(mixed):
    table, x, known, _ = mixed
    w = np.linspace(-0.3, 0.4, WIDTH)
    lost = lambda z: math.log1p(math.exp(-z))
    z = (x @ w).tolist()
    prior = 0.6
    positives = [a for a, k in zip(z, known, strict=True) if k]
    on_good = prior * sum(map(lost, positives)) / len(positives)
    negative = sum(lost(-a) for a in z) / len(z) - prior * sum(lost(-a) for a in positives) / len(positives)
    found = risk(table, w, prior)
    assert math.isclose(found.value, on_good + negative + quality.RIDGE / 2 * (w @ w), rel_tol=1e-9)
    assert math.isclose(found.negative, negative, rel_tol=1e-9)
    step = 1e-5 * np.eye(WIDTH)[3]
    slope = (risk(table, w + step, prior).value - risk(table, w - step, prior).value) / 2e-5
    assert math.isclose(slope, found.slope[3], rel_tol=1e-4, abs_tol=1e-7)
    bend = (risk(table, w + step, prior).slope - risk(table, w - step, prior).slope) / 2e-5
    assert np.allclose(bend, found.curve[3], rtol=1e-3, atol=1e-6)


def test_prior_and_classes_without_negative_labels(mixed):
    table, x, _, good = mixed
    model = quality.train(table)
    assert abs(model.prior - good.mean()) < 0.05
    assert ((model.scores(x) >= 0.5) == good).mean() > 0.97
    assert abs(estimated_prior(table, model.weights) - good.mean()) < 0.05


def test_risk_on_negatives_stays_above_zero(mixed):
    table = mixed[0]
    weights = fit(table, 0.95, np.zeros(WIDTH))  # more than the true share: the estimate would fall below zero
    found = risk(table, weights, 0.95)
    assert 0 <= found.negative < 0.02 and found.value < risk(table, np.zeros(WIDTH), 0.95).value


def test_accuracy_on_held_out_rows(spark):
    found = queries.op13_quality(spark, SF)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    good, bad = ([r["predicted"] for r in rows if r["held_out"] and r["quality"] == y] for y in (1, 0))
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.06 * len(bad)


def test_negative_labels_and_held_out_rows_teach_nothing(spark):
    small = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    fewer = labels.filter("quality = 1").filter(~held)
    one, two = ({r["doc_id"]: r["score"] for r in score_quality(docs, x, ["doc_id"]).collect()} for x in (labels, fewer))
    assert one.keys() == two.keys() and all(math.isclose(one[k], two[k], rel_tol=1e-6, abs_tol=1e-9) for k in one)


def test_odd_rows(spark, documents):
    rows = [*enumerate(ODD_TEXTS), (3, "twice"), (None, "no id")]
    docs = documents(rows, ", score int, _x string, quality int", (1, "x", 2))
    labels = spark.createDataFrame([(0, 1, 0), (3, 1, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0), (6, None, 0), (7, 2, 1)], LABELS)
    assert sorted(r["doc_id"] for r in trusted(labels).collect()) == [0, 3]
    out = score_quality(docs, labels)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "_x", "quality", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    for some in (labels.filter("quality = 0"), labels.limit(0)):
        assert {r["score"] for r in score_quality(docs, some, ["doc_id"]).collect()} == {quality.UNKNOWN}
    assert score_quality(docs.limit(0), labels).count() == 0
    assert with_numbers(docs).filter(F.size("_x") != WIDTH).count() == 0
