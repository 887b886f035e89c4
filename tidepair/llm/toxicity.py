"""Toxicity by weak supervision.

1. A bounded sample of labelled rows shows which words and beginnings of words are
   much more frequent in toxic texts.  Each becomes a voter that fires where its
   pattern occurs; a few more fire where many different patterns do, or none.
2. A generative label model explains the votes by a hidden class: how often each
   voter fires in either class, fitted by expectation maximization.  Voters that
   fire together beyond what the class explains are correlated: their votes are
   divided among them.
3. A linear classifier on the counts of the patterns is trained on the posterior
   labels of the model, and scores every text.

Sample (documented bound): ``SAMPLE_ROWS`` labelled rows of each class, in the order
of a hash of the id; the model, not its cost, is all that depends on it.  Rows are
weighed back to the shares of the classes among all labelled rows.

Defined cases: null counts as empty; an empty text scores as one without any
pattern; labels without an id or a value are not learned from, of labels that
repeat an id the largest counts; without labels of both classes every text scores
the share of toxic labels (0 without any).
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .language_id import letters

SAMPLE_ROWS = 6_000
PREFIXES = (4, 5, 6, 7)
VOTERS = 160
LEAST_TOXIC = 5  # different toxic texts of the sample that a pattern must occur in
LEAST_Z = 3.5
LEAST_PRECISION = 0.85  # share of toxic texts among those with the pattern, at natural shares
TOXIC_FROM = 0.3  # fixed value of the contract
ROUNDS = 60
CORRELATED = 0.3
TIMES = (1, 2, 3)  # occurrences of its pattern from which a voter may fire
MANY = (1, 2, 3)  # numbers of different patterns from which a count voter fires


def patterns_of(text: str) -> Counter:
    """Occurrences of words, as ' word ', and of beginnings of words, as ' wor'."""
    out: Counter = Counter()
    for word, times in Counter(letters(text).decode().split()).items():
        out[f" {word} "] += times
        for n in PREFIXES:
            if len(word) > n:
                out[f" {word[:n]}"] += times
    return out


class Finder:
    """Counts patterns in texts with an automaton, built where it is used."""

    def __init__(self, patterns: list[str]):
        self.patterns = patterns
        self.automaton = None

    def __getstate__(self):
        return {"patterns": self.patterns, "automaton": None}

    def counts(self, text: str) -> dict[int, int]:
        if not self.patterns:
            return {}
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for i, p in enumerate(self.patterns):
                self.automaton.add_word(p.encode().decode("latin-1"), i)
            self.automaton.make_automaton()
        reduced = b" " + letters(text) + b" "
        found: dict[int, int] = {}
        for _, i in self.automaton.iter(reduced.decode("latin-1")):
            found[i] = found.get(i, 0) + 1
        return found


def votes(counts: np.ndarray, times: np.ndarray) -> np.ndarray:
    """(row, voter): a voter for each pattern, for many patterns, and for none."""
    fires = counts >= times
    different = fires.sum(axis=1, keepdims=True)
    return np.hstack([fires, *(different >= m for m in MANY), different == 0]).astype(float)


class LabelModel(NamedTuple):
    """Share of toxic texts, rate of each voter in clean and toxic texts, and its weight."""

    prior: float
    rates: np.ndarray
    weights: np.ndarray

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        low, high = np.log(self.rates), np.log1p(-self.rates)
        one = fired @ (self.weights * (low[1] - low[0])) + (1 - fired) @ (self.weights * (high[1] - high[0]))
        return 1 / (1 + np.exp(-np.clip(one + np.log(self.prior / (1 - self.prior)), -500, 500)))


def fit_label_model(fired: np.ndarray, weight: np.ndarray, prior: float) -> LabelModel:
    """Expectation maximization from a start where more votes mean more likely toxic."""
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    strength = fired[:, :-1].sum(axis=1)
    y = np.clip(strength / max(1.0, np.quantile(strength, 0.95)), 0.02, 0.98)
    weights = np.ones(fired.shape[1])
    for turn in range(ROUNDS):
        mass = np.array([(weight * (1 - y)).sum(), (weight * y).sum()]) + 1e-9
        rates = np.clip(
            np.array([(weight * (1 - y)) @ fired + 0.5, (weight * y) @ fired + 0.5]) / (mass[:, None] + 1.0),
            1e-4, 1 - 1e-4,
        )
        if turn == ROUNDS // 3:
            weights = independence(fired, weight, y, rates)
        model = LabelModel(prior, rates, weights)
        y = model.posterior(fired)
    return model


def independence(fired: np.ndarray, weight: np.ndarray, y: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """1 / (number of voters that a voter is correlated with, itself included), from the
    correlations of what the class does not explain."""
    rest = (fired - (np.outer(1 - y, rates[0]) + np.outer(y, rates[1]))) * np.sqrt(weight)[:, None]
    norm = np.sqrt((rest**2).sum(axis=0)) + 1e-9
    correlation = np.abs(rest.T @ rest / np.outer(norm, norm))
    np.fill_diagonal(correlation, 1.0)
    return 1 / np.where(correlation >= CORRELATED, correlation, 0).sum(axis=1)


def features(counts: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Damped counts, the number of different voters that fire, and a constant."""
    different = (counts >= times).sum(axis=1, keepdims=True)
    return np.hstack([np.log1p(counts), np.minimum(different, 3), different > 0, np.ones_like(different)]).astype(float)


def fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps, with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.1)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        w -= np.linalg.solve(curve, gradient)
    return w


class Model(NamedTuple):
    finder: Finder
    times: np.ndarray  # occurrences from which the voter of a pattern fires
    weights: np.ndarray
    constant: float | None  # the score of every text if nothing could be learned

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        counts = np.zeros((len(texts), len(self.finder.patterns)))
        for k, text in enumerate(texts):
            for i, n in self.finder.counts(text or "").items():
                counts[k, i] = n
        return 1 / (1 + np.exp(-np.clip(features(counts, self.times) @ self.weights, -30, 30)))


def _chosen(usable: DataFrame) -> DataFrame:
    """(doc_id, toxic): the ``SAMPLE_ROWS`` labels of each class with the least hashes.
    Every task passes on its least ones only."""
    clean, toxic = (
        usable.filter(F.col("toxic") == y)
        .select("doc_id", "toxic")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
        for y in (0, 1)
    )
    return clean.union(toxic)


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """(text, toxic) of the sample, and the numbers of all labels that may be learned from."""
    usable = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    chosen = _chosen(usable)
    # at most 2 * SAMPLE_ROWS ids
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"]) for r in chosen.collect()], chosen.schema)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic"), sizes


def text_family(text: str) -> int:
    """The least hash of three words in a row: near copies mostly share it."""
    words = letters(text).split()
    return min(
        (xxhash.xxh3_64_intdigest(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))),
    ) >> 1


def mine_patterns(sample: DataFrame, share: float, ratio: float) -> dict[str, int]:
    """Patterns that toxic texts show far more often, the strongest first, with the
    number of occurrences from which they tell toxic texts.  ``share``
    is the number of clean sample rows over that of toxic ones, ``ratio`` the same
    among all labels.  Of near copies one is counted, as all their words repeat."""

    def family(batches):
        for batch in batches:
            found = [text_family(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), batch.column("toxic"), pa.array(found, pa.int64())],
                names=["text", "toxic", "family"],
            )

    different = sample.mapInArrow(family, "text string, toxic int, family long").dropDuplicates(
        ["family", "toxic"]
    )

    def count(batches):
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                for pattern, n in patterns_of(text.as_py() or "").items():
                    seen[toxic].update((pattern, t) for t in TIMES if n >= t)
        every = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in every], pa.string()),
                pa.array([t for _, t in every], pa.int64()),
                *(pa.array([seen[y][p] for p in every], pa.int64()) for y in (1, 0)),
            ],
            names=["pattern", "times", "toxic", "clean"],
        )

    sums = (
        different.mapInArrow(count, "pattern string, times long, toxic long, clean long")
        .groupBy("pattern", "times")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= LEAST_TOXIC)
    )
    odds = F.log((F.col("toxic") + 0.5) / ((F.col("clean") + 0.5) / share))
    z = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    clean = F.col("clean") * ratio / share
    strong = (
        sums.withColumn("z", z)
        .filter((F.col("z") >= LEAST_Z) & (F.col("toxic") >= LEAST_PRECISION * (F.col("toxic") + clean)))
        .orderBy(F.desc("z"), "pattern", "times")
        .limit(4 * VOTERS)
    )
    out: dict[str, int] = {}
    for row in strong.collect():
        p = row["pattern"]
        if len(out) < VOTERS and not any(p.startswith(o) or o.startswith(p.rstrip()) for o in out):
            out[p] = row["times"]
    return out


def train(docs: DataFrame, labels: DataFrame) -> Model:
    sample, sizes = _sample(docs, labels)
    total = sum(sizes.values())
    if len(sizes) < 2:
        return Model(Finder([]), np.zeros(0), np.zeros(0), float(sizes.get(1, 0) / total) if total else 0.0)
    taken = {y: min(n, SAMPLE_ROWS) for y, n in sizes.items()}
    mined = mine_patterns(sample, taken[0] / taken[1], sizes[0] / sizes[1])
    finder, times = Finder(list(mined)), np.array(list(mined.values()))

    def count(batches):
        for batch in batches:
            rows = [finder.counts(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("toxic"),
                    pa.array([list(r) for r in rows], pa.list_(pa.int32())),
                    pa.array([list(r.values()) for r in rows], pa.list_(pa.int64())),
                ],
                names=["doc_id", "toxic", "which", "n"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    rows = sample.mapInArrow(count, f"doc_id {kind}, toxic int, which array<int>, n array<long>")
    found = sorted(rows.collect())  # sparse counts of a few voters for each row of the sample
    counts = np.zeros((len(found), len(finder.patterns)))
    for k, row in enumerate(found):
        counts[k, row["which"]] = row["n"]
    weight = np.array([sizes[r["toxic"]] / taken[r["toxic"]] for r in found])
    if not len(found) or not finder.patterns:
        return Model(Finder([]), np.zeros(0), np.zeros(0), float(sizes[1] / total))
    fired = votes(counts, times)
    y = fit_label_model(fired, weight, sizes[1] / total).posterior(fired)
    return Model(finder, times, fit_linear(features(counts, times), y, weight), None)


def score_toxicity(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all) with ``score`` and ``predicted``.
    Columns of ``docs`` with one of these names are replaced."""
    keep = [c for c in (docs.columns if columns is None else columns) if c not in ("score", "predicted")]
    chosen = docs.select(*dict.fromkeys([*keep, "text"]))

    def score(batches):
        for batch in batches:
            found = [
                model.scores([t.as_py() for t in batch.column("text")[i : i + 1000]])
                for i in range(0, batch.num_rows, 1000)
            ]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array(scores), pa.array((scores >= TOXIC_FROM).astype(np.int32))],
                names=[*keep, "score", "predicted"],
            )

    out = chosen.select(*keep).withColumns(
        {"score": F.lit(None).cast("double"), "predicted": F.lit(None).cast("int")}
    )
    return chosen.mapInArrow(score, out.schema)
