"""Quality by learning from trusted positives and unlabelled text.

1. Every text is described once by ``WIDTH`` numbers: how its kinds of bytes follow
   each other, how much of it repeats, and how long it is.  The table of these
   numbers serves all later steps; texts are not read again.
2. A logistic classifier minimises the non-negative unbiased risk: with the class
   prior p, positives P and unlabelled rows U, the risk on negatives is estimated as
   the mean over U less p times the mean over P.  Rows labelled negative are never
   used as such.  Newton steps use sums over all rows, a job each; a step after
   which the estimate of the risk on negatives would be below zero, which only
   overfitting can bring about, is shortened until it is not.
3. The class prior is estimated from the same two sets: the least ratio of the
   shares of U and P above a score, where a bound on its error is smallest.  A first
   classifier with an even prior finds it, two more refine it.

All sums are over all rows that may be learned from, so there is no sample; a task
passes on ``WIDTH`` squared short rows and the driver gets as many.

Defined cases: null counts as empty, and an empty text scores by its numbers as any
other; an id is a trusted positive if it has a label and all its labels are 1;
labels without an id or a value are not learned from; without positives, or without
rows to learn from, every text scores ``UNKNOWN``; rows that repeat an id are rows of
their own; columns of ``docs`` named like a result are replaced, others are kept.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import held_out
from .textbytes import VISIBLE, Chunk, chunks, words

# Fixed values of the contract.
FOLDS, HELD_OUT = 5, 0
GOOD_FROM = 0.3

UNKNOWN = 0.5
FIRST_PRIOR = 0.5
REFINED = 2
STEPS = 12
HALVINGS = 8
RIDGE = 1e-4
ENOUGH = 1e-7  # fall of the risk below which steps end
CONFIDENCE = 0.1
BINS, REACH = 2000, 20.0  # scores in bins, as log odds
LEAST_SHARE, MOST_PRIOR = 0.01, 0.999

# Kinds of bytes: small and capital letters, bytes beyond ASCII, digits, space,
# other blanks, common punctuation, and the rest.
KINDS = 8
_KIND = np.full(256, 7, np.int64)
for _kind, _bytes in enumerate(
    (range(0x61, 0x7B), range(0x41, 0x5B), range(0x80, 0x100), range(0x30, 0x3A), b" ", range(0x09, 0x0E), b".,;:'-?\"()")
):
    _KIND[list(_bytes)] = _kind
_LINE = np.arange(256) != 0x0A
WIDTH = KINDS * KINDS + 11


def described(chunk: Chunk) -> np.ndarray:
    """(row, ``WIDTH``): the numbers of each text of a chunk."""
    n = len(chunk.offsets) - 1
    kind = _KIND[chunk.data]
    size = np.diff(chunk.offsets)
    row = np.repeat(np.arange(n), size)
    same = row[1:] == row[:-1]
    pair = (row[1:] * KINDS + kind[:-1]) * KINDS + kind[1:]
    pairs = np.bincount(pair[same], minlength=n * KINDS * KINDS).reshape(n, -1)
    share = np.sqrt(pairs / np.maximum(1, size - 1)[:, None])
    found, lines = words(chunk, VISIBLE), words(chunk, _LINE)
    three = found.hash[:-2] * np.uint64(3) + found.hash[1:-1] * np.uint64(5) + found.hash[2:] * np.uint64(7)
    rest = np.zeros((n, WIDTH - KINDS * KINDS))
    for i in range(n):
        a, b = found.first[i : i + 2].tolist()
        c, d = lines.first[i : i + 2].tolist()
        _, times = np.unique(found.hash[a:b], return_counts=True)
        count, runs = b - a, max(0, b - a - 2)
        rest[i] = (
            np.log1p(count) / 10,
            len(times) / max(1, count),
            len(np.unique(three[a : a + runs])) / max(1, runs),
            times.max() / count if count else 0,
            len(np.unique(lines.hash[c:d])) / max(1, d - c),
            min(1, 5 * (d - c) / max(1, count)),
            min(20, size[i] / max(1, count)) / 10,
            count < 50,
            count < 10,
            count == 0,
            1,
        )
    return np.hstack([share, rest])


def with_numbers(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_x``, the numbers, in place of the text and of a column of that name."""
    keep = [c for c in docs.columns if c not in ("text", "_x")]

    def describe(batches):
        for batch in batches:
            found = [described(chunk) for chunk in chunks(batch.column("text"))]
            flat = np.concatenate([np.zeros(0), *(f.ravel() for f in found)]).astype(np.float32)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * WIDTH
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists], names=[*keep, "_x"])

    return docs.mapInArrow(describe, docs.select(*keep).withColumn("_x", F.lit(None).cast("array<float>")).schema)


def trusted(labels: DataFrame) -> DataFrame:
    """(doc_id): the ids that all their labels call good."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("least"))
        .filter("least = 1")
        .select("doc_id")
    )


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column("_x").flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)
    return x, batch.column("_good").to_numpy(zero_copy_only=False)


def _summed(table: DataFrame, of, slots: int) -> np.ndarray:
    """The sums over all rows of ``of(x, good)``, arrays of ``slots`` numbers."""

    def add(batches):
        total = np.zeros(slots)
        for batch in batches:
            if batch.num_rows:
                total += of(*_rows(batch))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(slots)), pa.array(total)], names=["slot", "value"])

    sums = table.select("_x", "_good").mapInArrow(add, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value"))
    found = sums.toArrow()
    out = np.zeros(slots)
    out[found["slot"].to_numpy()] = found["value"].to_numpy()
    return out


class Risk(NamedTuple):
    """Risk at some weights, the estimated part of it on negatives, slope and curvature."""

    value: float
    negative: float
    slope: np.ndarray
    curve: np.ndarray


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def risk(table: DataFrame, weights: np.ndarray, prior: float) -> Risk:
    """The unbiased risk on ``table`` (_x, _good), whose rows are unlabelled ones, and
    positives too where ``_good``.  With logistic losses l(z) - l(-z) = -z, so that the
    positives enter by their mean."""

    def of(x, good):
        z = x @ weights
        p = sigmoid(z)
        loss = np.logaddexp(0, z)  # of a row taken as negative
        square = (x * (p * (1 - p))[:, None]).T @ x
        return np.concatenate(
            [[len(x), good.sum(), loss.sum(), loss[good].sum()], x.T @ p, x[good].sum(axis=0), square.ravel()]
        )

    sums = _summed(table, of, 4 + 2 * WIDTH + WIDTH * WIDTH)
    n, m, loss, loss_good = sums[:4]
    slope, good, curve = np.split(sums[4:], [WIDTH, 2 * WIDTH])
    good = good / m
    return Risk(
        loss / n - prior * weights @ good + RIDGE / 2 * weights @ weights,
        loss / n - prior * loss_good / m,
        slope / n - prior * good + RIDGE * weights,
        curve.reshape(WIDTH, WIDTH) / n + RIDGE * np.eye(WIDTH),
    )


def fit(table: DataFrame, prior: float, weights: np.ndarray) -> np.ndarray:
    """Weights of least non-negative risk, from a start where that is not below zero."""
    now = risk(table, weights, prior)
    for _ in range(STEPS):
        step = np.linalg.solve(now.curve, now.slope)
        for half in range(HALVINGS):
            to = weights - step / 2**half
            then = risk(table, to, prior)
            if then.value < now.value and then.negative >= 0:
                break
        else:
            return weights
        fall, weights, now = now.value - then.value, to, then
        if fall < ENOUGH:
            return weights
    return weights


def estimated_prior(table: DataFrame, weights: np.ndarray) -> float:
    """Share of good rows among all: above some score nearly all rows are good, so
    there the share of all rows above it is that of the good ones times the prior."""

    def of(x, good):
        at = np.clip((x @ weights + REACH) / (2 * REACH) * BINS, 0, BINS - 1).astype(np.int64)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at[good], minlength=BINS)])

    every, good = _summed(table, of, 2 * BINS).reshape(2, BINS)
    above, above_good = (np.cumsum(c[::-1])[::-1] / c.sum() for c in (every, good))
    some = above_good >= LEAST_SHARE
    width = np.sqrt(np.log(4 / CONFIDENCE) / 2) * (every.sum() ** -0.5 + good.sum() ** -0.5)
    best = np.argmin((above[some] + width) / above_good[some])
    return float(min(MOST_PRIOR, above[some][best] / above_good[some][best]))


class Model(NamedTuple):
    weights: np.ndarray | None  # None if nothing could be learned
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), UNKNOWN) if self.weights is None else sigmoid(x @ self.weights)


def train(table: DataFrame) -> Model:
    """A model from rows (_x, _good)."""
    if not table.filter("_good").limit(1).count():
        return Model(None, UNKNOWN)
    prior = FIRST_PRIOR
    for _ in range(REFINED):
        prior = estimated_prior(table, fit(table, prior, np.zeros(WIDTH)))
    return Model(fit(table, prior, np.zeros(WIDTH)), prior)


def score_quality(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all but the text) with ``score`` and ``predicted``."""
    keep = [c for c in (docs.columns if columns is None else columns) if c not in ("score", "predicted", "text")]
    named = docs.select(*(F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)), F.col("doc_id").alias("_id"), "text")
    good = trusted(labels).select(F.col("doc_id").alias("_id"), F.lit(True).alias("_good"))
    table = materialize(
        with_numbers(named).join(good, "_id", "left").withColumn("_good", F.coalesce("_good", F.lit(False))), "numbers"
    )
    model = train(table.filter(~held_out("_id", FOLDS, HELD_OUT)))

    def score(batches):
        for batch in batches:
            scores = model.scores(_rows(batch)[0]) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f"_c{i}") for i in range(len(keep))]
                + [pa.array(scores), pa.array((scores >= GOOD_FROM).astype(np.int32))],
                names=[*keep, "score", "predicted"],
            )

    out = docs.select(*keep).withColumns({"score": F.lit(None).cast("double"), "predicted": F.lit(None).cast("int")})
    return table.select(*(f"_c{i}" for i in range(len(keep))), "_x", "_good").mapInArrow(score, out.schema)
