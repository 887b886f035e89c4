"""The best k matches without scoring every pair of topics.

For series and visits that are complete and not negative, a pair can be judged
without going over the days with each series.  With products x.a and x.b of a series
and two topics, and the products a.b of all topics of two blocks (their Gram
matrix), made once:

* mean: x.(a+b) = x.a + x.b and |a+b|^2 = a.a + b.b + 2 a.b, so the score follows;
* min and max: x.min is at most the lesser of x.a and x.b, and x.max at most their
  sum.  |min|^2 is worked out once for each pair of a tile, whatever the number of
  series, and |max|^2 = a.a + b.b - |min|^2.  That gives upper bounds.

Pairs are looked at from the highest bound downwards, those of a chunk of series
together, and scored over the days in strips until no bound that is left can
reach the k-th best score seen.  Nothing is lost: a pair that is never scored can
not be among the best k.  Other data go the way of :class:`TopCosineKernel`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidepair.operators.tiles import CHUNK, TopCosineKernel

# Bounds and roundings of sums in another order may differ by this much.
ROUNDING = 1e-9
# Scores that are worked out between two looks at the k-th best.
STRIP = 1 << 10
# Numbers of a chunk of series times the pairs of two blocks that are held at once.
HELD = 1 << 22


class BoundedTopKernel(TopCosineKernel):
    """As the kernel above it, with bounds.  ``scored`` counts the scores that were
    worked out over days, ``possible`` the pairs of series and topic pair."""

    def __init__(self, k: int, measures: tuple[str, ...], slack: float) -> None:
        super().__init__(k, measures, slack)
        self.scored = self.possible = 0

    def _prepare(self) -> None:
        super()._prepare()
        self.bounded = self.complete and self.non_negative and len(self.days) > 0
        if not self.bounded:
            return
        # the pairs of the tile: each unordered pair of one block once
        order = self.left_rank[:, None] < self.right_rank[None, :]
        self.a, self.b = np.nonzero(order if self.same_block else np.ones(order.shape, bool))
        gram = (self.left @ self.right.T)[self.a, self.b]
        total = self.left_square[self.a] + self.right_square[self.b]
        low = np.empty(len(total))
        step = max(1, HELD // len(self.days))
        for at in range(0, len(low), step):
            least = np.minimum(self.left[self.a[at : at + step]], self.right[self.b[at : at + step]])
            low[at : at + step] = np.einsum("ij,ij->i", least, least)
        high = np.maximum(total - low, total / 2)
        with np.errstate(divide="ignore"):
            self.over = {
                "mean": 1 / np.sqrt(total + 2 * gram),
                "min": 1 / np.sqrt(low),
                "max": 1 / np.sqrt(high),
            }

    def _score(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not self.bounded:
            yield from super()._score(batch)
            return
        step = max(1, min(CHUNK, HELD // max(1, len(self.a))))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            x, present = self._block(part)
            if not present.all() or (x < 0).any():
                yield from super()._score(part)
                continue
            self._begin(part)
            norm = np.sqrt((x * x).sum(axis=1))
            some = np.flatnonzero(norm > 0)  # others have no score
            if len(some) and len(self.a):
                left, right = ((x[some] / norm[some, None]) @ m.T for m in (self.left, self.right))
                for measure in self.measures:
                    self._search(measure, some, x, norm, left[:, self.a], right[:, self.b])
            yield from self._end()

    def _search(self, measure, some, x, norm, left, right) -> None:
        """Score from the highest bound downwards.  A score is at most 1."""
        share = np.minimum(left, right) if measure == "min" else left + right
        with np.errstate(invalid="ignore"):
            bound = np.minimum(np.nan_to_num(share * self.over[measure], nan=1.0, posinf=1.0), 1.0)
        bound += ROUNDING
        self.possible += bound.size
        can = np.flatnonzero(bound.ravel() >= self.best[measure].min() - self.slack)
        can = can[np.argsort(-bound.ravel()[can], kind="stable")]
        for at in range(0, len(can), STRIP):
            strip = can[at : at + STRIP]
            if bound.ravel()[strip[0]] < self.best[measure].min() - self.slack:
                break
            row, pair = np.divmod(strip, bound.shape[1])
            self._keep(measure, some[row], pair, self._exact(measure, x[some[row]], norm[some[row]], pair))

    def _exact(self, measure, x, norm, pair) -> np.ndarray:
        self.scored += len(pair)
        a, b = self.left[self.a[pair]], self.right[self.b[pair]]
        y = {"mean": lambda: (a + b) / 2, "min": lambda: np.minimum(a, b), "max": lambda: np.maximum(a, b)}[measure]()
        both = norm * np.sqrt((y * y).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(both > 0, np.einsum("ij,ij->i", x, y) / both, np.nan)

    def _keep(self, measure, series, pair, score) -> None:
        usable = ~np.isnan(score)
        seen = np.concatenate([self.best[measure], score[usable]])
        self.best[measure] = np.partition(seen, len(seen) - self.k)[-self.k :]
        good = usable & (score >= self.best[measure].min() - self.slack)
        if not good.any():
            return
        series, pair, score = series[good], pair[good], score[good]
        i, j = self.a[pair], len(self.left_names) + self.b[pair]
        first = self.left_rank[self.a[pair]] < self.right_rank[self.b[pair]]
        self.parts.append(
            (series, np.where(first, i, j), np.where(first, j, i), score,
             np.full(len(series), self.MEASURES.index(measure)))
        )
        self.part_rows += len(series)
