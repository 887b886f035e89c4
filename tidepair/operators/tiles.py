"""Tiles: groups of rows that stream through one Arrow task at a time.

Rows carry integer key columns that name a tile, and a ``side``.  Spark
partitions them by tile and sorts each partition by (tile, side, name), so a
task sees the tiles one after another, and in each tile the small fixed sides
before the long one.  The kernel holds only the fixed sides of one tile; the
last side flows past in Arrow batches and is never gathered.  Both kernels are
dense matrix products on blocks, of bounded size.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, IntegerType, LongType, StructField, StructType

from tidepair.session import ship_package, shuffle_partitions

# Rows of the streamed side that are expanded to a dense block at a time.
CHUNK = 512
# Result rows that are gathered before they are passed on.
FLUSH_ROWS = 200_000


def run_tiles(
    rows: DataFrame,
    key: list[str],
    order: str,
    kernel: Callable[[], Any],
    schema: str | StructType,
    tiles: int,
    number: Column | None = None,
) -> DataFrame:
    """Feed ``rows`` to kernels.

    A number of partitions is stated, from the number of ``tiles``: tiles are few
    bytes and much work, so they are not to be coalesced by their size.  With a
    ``number`` of each tile they are dealt evenly by it, else by a hash of the key: of
    tiles as few as tasks, a hash puts several in one task and none in another.

    ``kernel()`` is made once per task; it gets ``open(tile)`` at the start of
    each tile and ``feed(side, batch)`` for each run of rows with one side, and
    yields result batches.  If it has a ``close()``, that is called at the end of each
    tile and may yield more.
    """
    ship_package(rows.sparkSession)

    def drive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, tile = kernel(), None
        close = getattr(state, "close", lambda: ())
        for batch in batches:
            if batch.num_rows == 0:
                continue
            marks = np.stack([batch.column(c).to_numpy() for c in [*key, "side"]])
            changes = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            cuts = [0, *changes.tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                here = tuple(int(m) for m in marks[:-1, begin])
                if here != tile:
                    if tile is not None:
                        yield from close()
                    tile = here
                    state.open(tile)
                yield from state.feed(int(marks[-1, begin]), batch.slice(begin, end - begin))
        if tile is not None:
            yield from close()

    partitions = max(1, min(tiles, 4 * shuffle_partitions(rows.sparkSession)))
    if number is None:
        dealt = rows.repartition(partitions, *key)
    else:
        dealt = rows.repartitionById(partitions, F.pmod(number, F.lit(partitions)).cast("int"))
    tiled = dealt.sortWithinPartitions(*key, "side", order)
    return tiled.mapInArrow(drive, schema)


def list_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """A list column as (row number of each entry, entries)."""
    column = batch.column(name)
    lengths = np.diff(column.offsets.to_numpy())
    entries = column.flatten().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), lengths), entries


def _cosine(product: np.ndarray, x_norm: np.ndarray, y_norm: np.ndarray) -> np.ndarray:
    norm = x_norm * y_norm
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norm > 0, product / norm, np.nan)


class CosineKernel:
    """Scores of series (side 2) against pairs of topics (sides 0 and 1).

    A tile holds one block of topics for each side.  A tile of one block with
    itself gets side 1 only, and takes each unordered pair of it once.
    """

    MEASURES = ("mean", "min", "max")

    def open(self, tile: tuple[int, ...]) -> None:
        self.same_block = tile[-2] == tile[-1]
        self.topics: list[list[pa.RecordBatch]] = [[], []]
        self.ready = False

    def feed(self, side: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if side < 2:
            self.topics[side].append(batch)
            return
        if not self.ready:
            self._prepare()
        for at in range(0, batch.num_rows if len(self.days) else 0, CHUNK):
            yield from self._score(batch.slice(at, CHUNK))

    def _prepare(self) -> None:
        """Lay the blocks of topics out as (topic, day) matrices."""
        sides = [[b for b in side if b.num_rows] for side in self.topics]
        days = [list_column(b, "days")[1] for side in sides for b in side]
        self.days = np.unique(np.concatenate(days)) if days else np.empty(0, np.int32)
        laid_out = [self._matrix(side) for side in sides]
        left, right = laid_out[1 if self.same_block else 0], laid_out[1]
        self.left_names, self.left, self.left_present = left
        self.right_names, self.right, self.right_present = right
        self.names = pa.array(self.left_names + self.right_names, pa.string())
        # names as numbers in their order, so that partners need no comparison of texts
        order = sorted(set(self.left_names) | set(self.right_names))
        rank = {name: k for k, name in enumerate(order)}
        self.left_rank = np.array([rank[n] for n in self.left_names], np.int64)
        self.right_rank = np.array([rank[n] for n in self.right_names], np.int64)
        present = (self.left_present, self.right_present)
        self.complete = all(m.all() for m in present)
        self.non_negative = all((m >= 0).all() for m in (self.left, self.right))
        self.left_square = (self.left**2).sum(axis=1)
        self.right_square = (self.right**2).sum(axis=1)
        self.ready = True

    def _matrix(self, batches: list[pa.RecordBatch]) -> tuple[list[str], np.ndarray, np.ndarray]:
        parts = [self._block(b) for b in batches]
        if not parts:
            empty = np.zeros((0, len(self.days)))
            return [], empty, empty
        names = [n for b in batches for n in b.column("name").to_pylist()]
        return names, *(np.concatenate(m) for m in zip(*parts))

    def _block(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Rows as (values, presence) over the days of the tile's topics."""
        row, days = list_column(batch, "days")
        vals = list_column(batch, "vals")[1]
        values = np.zeros((batch.num_rows, len(self.days)))
        present = np.zeros(values.shape)
        column = np.searchsorted(self.days, days)
        known = column < len(self.days)
        known[known] = self.days[column[known]] == days[known]
        values[row[known], column[known]] = vals[known]
        present[row[known], column[known]] = 1.0
        return values, present

    def _score(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x, x_present = self._block(batch)
        self._begin(batch)
        if self.complete and self.non_negative and x_present.all():
            score = self._score_complete
            known = x @ self.right.T, np.sqrt((x * x).sum(axis=1))
        else:
            score = self._score_shared
            known = x * x, x_present
        for i, own in enumerate(self.left_rank):
            partners = np.arange(len(self.right_rank))
            if self.same_block:
                partners = np.flatnonzero(own < self.right_rank)
            if not len(partners):
                continue
            scores, met = score(i, partners, x, *known)
            first = own < self.right_rank[partners]
            other = len(self.left_names) + partners
            topic1, topic2 = np.where(first, i, other), np.where(first, other, i)
            yield from self._take(scores, met, topic1, topic2)
        yield from self._end()

    def _score_complete(self, i, partners, x, x_right, x_norm):
        """All have every day and visits are not negative.  The mean and the
        maximum then follow from the minimum, as max = a + b - min, so one
        matrix product is left to do."""
        a, b = self.left[i], self.right[partners]
        low = np.minimum(a, b)
        both = (x @ a)[:, None] + x_right[:, partners]
        x_low = x @ low.T
        squares = self.left_square[i] + self.right_square[partners]
        low_square = (low * low).sum(axis=1)
        scores = [
            _cosine(both / 2, x_norm[:, None], np.sqrt((squares + 2 * (b @ a)) / 4)),
            _cosine(x_low, x_norm[:, None], np.sqrt(low_square)),
            _cosine(both - x_low, x_norm[:, None], np.sqrt(squares - low_square)),
        ]
        return scores, None

    def _score_shared(self, i, partners, x, x_square, x_present):
        """Sums and norms over the days that the series and both topics have."""
        a, b = self.left[i], self.right[partners]
        shared = self.left_present[i] * self.right_present[partners]
        x_norm = np.sqrt(x_square @ shared.T)
        scores = []
        for y in ((a + b) / 2, np.minimum(a, b), np.maximum(a, b)):
            y = y * shared
            scores.append(_cosine(x @ y.T, x_norm, np.sqrt(x_present @ (y * y).T)))
        return scores, (x_present @ shared.T) > 0

    # -- results: every score -------------------------------------------------

    def _begin(self, batch: pa.RecordBatch) -> None:
        self.series_array = batch.column("name")
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.part_rows = 0

    def _take(self, scores, met, topic1, topic2) -> Iterator[pa.RecordBatch]:
        if met is None:
            met = np.ones(scores[0].shape, dtype=bool)
        series, pair = np.nonzero(met)
        self.parts.append((series, topic1[pair], topic2[pair], *(s[series, pair] for s in scores)))
        self.part_rows += len(series)
        if self.part_rows >= FLUSH_ROWS:
            yield from self._end()

    def _end(self) -> Iterator[pa.RecordBatch]:
        if self.part_rows:
            series, topic1, topic2, *scores = (np.concatenate(p) for p in zip(*self.parts))
            yield pa.RecordBatch.from_arrays(
                [
                    self.series_array.take(pa.array(series)),
                    self.names.take(pa.array(topic1)),
                    self.names.take(pa.array(topic2)),
                    *(pa.array(s, from_pandas=True) for s in scores),
                ],
                names=["series", "topic1", "topic2", "cos_mean", "cos_min", "cos_max"],
            )
        self.parts, self.part_rows = [], 0


class TopCosineKernel(CosineKernel):
    """As above, but only scores that can still be among the best ``k``.

    Per measure a task remembers the k-th best score it has seen; everything
    that reaches it less ``slack``, ties included, is passed on.  So the best k
    of all results are among the rows passed on, under any order of ties and
    any rounding by less than the slack.
    """

    def __init__(self, k: int, measures: tuple[str, ...], slack: float) -> None:
        self.k, self.measures, self.slack = k, measures, slack
        self.best = {m: np.full(k, -np.inf) for m in measures}

    def _take(self, scores, met, topic1, topic2) -> Iterator[pa.RecordBatch]:
        for measure, score in zip(self.MEASURES, scores):
            if measure not in self.measures:
                continue
            usable = ~np.isnan(score) if met is None else met & ~np.isnan(score)
            seen = np.concatenate([self.best[measure], score[usable]])
            self.best[measure] = np.partition(seen, len(seen) - self.k)[-self.k:]
            series, pair = np.nonzero(usable & (score >= self.best[measure].min() - self.slack))
            if len(series):
                self.parts.append(
                    (series, topic1[pair], topic2[pair], score[series, pair],
                     np.full(len(series), self.MEASURES.index(measure)))
                )
                self.part_rows += len(series)
        if self.part_rows >= FLUSH_ROWS:
            yield from self._end()

    def _end(self) -> Iterator[pa.RecordBatch]:
        if self.part_rows:
            series, topic1, topic2, score, measure = (np.concatenate(p) for p in zip(*self.parts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(self.MEASURES)).take(pa.array(measure)),
                    self.series_array.take(pa.array(series)),
                    self.names.take(pa.array(topic1)),
                    self.names.take(pa.array(topic2)),
                    pa.array(score),
                ],
                names=["measure", "series", "topic1", "topic2", "similarity"],
            )
        self.parts, self.part_rows = [], 0


class SketchKernel:
    """Inner products of stream sketches: side 0 is held, side 1 streams past.  A block that
    meets itself has no side 1 and streams past itself when all of it is held.

    The tile key starts with the window and ends in (row block, column block).
    Products are sums of non-negative integers, taken in doubles: exact while they
    are below 2^53 (or in single precision while none can reach 2^24).  What reaches
    2^53 is summed again in integers of any size, pair by pair, and only for pairs that
    are emitted, as ``large``; others are ``small``.  A hot stream with itself is none.
    Rows are held as lists of cells and laid out dense in parts, over the buckets in use.
    """

    # When fewer than one pair in this many passes the first function, the
    # other functions are taken pair by pair rather than for the whole block.
    SPARSE = 50
    # Held rows that are multiplied at a time, and the memory of their dense form.
    PART, PART_BYTES = 4096, 64 << 20
    # The dense form of all held rows is kept up to so many bytes, else made again
    # for each run of the streamed side.
    KEEP_BYTES = 256 << 20
    # Sums of whole numbers below this are exact in single precision.
    SINGLE = 2.0**24

    def __init__(self, depth: int, buckets: int, threshold: int, per_function: bool) -> None:
        self.depth, self.buckets = depth, buckets
        self.threshold, self.per_function = threshold, per_function

    def open(self, tile: tuple[int, ...]) -> None:
        self.window = tile[0]
        self.same_block = tile[-2] == tile[-1]
        self.held: list[pa.RecordBatch] = []
        self.ready = False

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.same_block and self.held and not self.ready:
            self._hold()
            yield from self.feed(1, self.row_batch)

    def feed(self, side: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if side == 0:
            self.held.append(batch)
            return
        if not self.held:
            return
        if not self.ready:
            self._hold()
        for at in range(0, batch.num_rows, CHUNK):
            yield from self._compare(batch.slice(at, CHUNK))

    def _hold(self) -> None:
        """Cells that no held row counts in bring nothing, so they get no column."""
        self.row_batch = pa.Table.from_batches(self.held).combine_chunks().to_batches()[0]
        self.held = [self.row_batch]
        self.row_ids = self.row_batch.column("sid").to_numpy()
        used = np.zeros(self.depth * self.buckets, dtype=bool)
        used[self.row_batch.column("cells").flatten().to_numpy(zero_copy_only=False)] = True
        self.place = np.where(used, np.cumsum(used) - 1, -1)
        self.width = int(used.sum())
        ends = np.concatenate([[0], np.cumsum(used.reshape(self.depth, self.buckets).sum(axis=1))]).tolist()
        self.columns = [slice(*f) for f in zip(ends, ends[1:])]
        self.row_square = max(
            (self._most_square(self.row_batch.slice(at, self.PART)) for at in range(0, len(self.row_ids), self.PART)),
            default=0.0,
        )
        size = max(1, min(self.PART, self.PART_BYTES // max(1, 8 * self.width)))
        self.parts = [slice(at, min(at + size, len(self.row_ids))) for at in range(0, len(self.row_ids), size)]
        self.kept: dict[tuple[int, type], list[np.ndarray]] = {}
        self.ready = True

    @staticmethod
    def _most_square(batch: pa.RecordBatch) -> float:
        row, n = list_column(batch, "counts")
        n = n.astype(np.float64)
        return float(np.bincount(row, n * n, batch.num_rows).max(initial=0.0))

    def _dense(self, batch: pa.RecordBatch, kind: type) -> list[np.ndarray]:
        """A matrix (row, used bucket) for each function."""
        row, cells = list_column(batch, "cells")
        counts = list_column(batch, "counts")[1]
        column = self.place[cells]
        known = column >= 0
        dense = np.zeros((batch.num_rows, self.width), kind)
        dense[row[known], column[known]] = counts[known]
        return [np.ascontiguousarray(dense[:, c]) for c in self.columns]

    def _held_part(self, part: slice, kind: type) -> list[np.ndarray]:
        key = part.start, kind
        if key in self.kept:
            return self.kept[key]
        dense = self._dense(self.row_batch.slice(part.start, part.stop - part.start), kind)
        if np.dtype(kind).itemsize * self.width * len(self.row_ids) <= self.KEEP_BYTES:
            if any(k[1] is not kind for k in self.kept):
                self.kept.clear()
            self.kept[key] = dense
        return dense

    def _exactly(self, row: int, batch: pa.RecordBatch, column: int, f: int) -> int:
        """One inner product in integers of any size."""
        cells = []
        for rows, k in ((self.row_batch, row), (batch, column)):
            at = rows.column("cells")[k].as_py(), rows.column("counts")[k].as_py()
            cells.append({c: n for c, n in zip(*at) if c // self.buckets == f})
        return sum(n * cells[1].get(c, 0) for c, n in cells[0].items())

    def _products(self, row, column, product, batch, f):
        """The products of pairs, exact: as doubles, or as integers if some are large."""
        large = np.flatnonzero(product >= 2.0**53)
        if len(large):
            product = product.astype(object)
            for k in large:
                product[k] = self._exactly(int(row[k]), batch, int(column[k]), f)
        return product

    def _compare(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column("sid").to_numpy()
        # no product is above the root of the squares
        most = self.row_square * self._most_square(batch)
        kind = np.float32 if most < self.SINGLE**2 else np.float64
        columns = self._dense(batch, kind)
        for part in self.parts:
            row_ids = self.row_ids[part]
            ordered = None
            if self.same_block:
                if row_ids.max() < ids.min():
                    continue
                if row_ids.min() <= ids.max():
                    ordered = self._ordered(row_ids, ids)
            compare = self._compare_part if most < 2.0**105 else self._compare_large
            yield from compare(batch, ids, columns, part, self._held_part(part, kind), ordered)

    def _ordered(self, row_ids: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Of a block with itself, which pairs (streamed row, held row) are taken."""
        return row_ids[None, :] > ids[:, None]

    def _compare_part(self, batch, ids, columns, part, rows, ordered) -> Iterator[pa.RecordBatch]:
        """Of the streamed rows with a part of the held ones, where no product reaches 2^53."""
        if self.per_function:
            for f in range(self.depth):
                product = columns[f] @ rows[f].T
                yield from self._pass_on(product, self._hit(product, 0.0, ordered), part, ids, f)
            return
        floor = float(self.threshold)
        least = columns[0] @ rows[0].T
        for f in range(1, self.depth + 1):
            hit = self._hit(least, floor, ordered)
            found = np.count_nonzero(hit)
            if f == self.depth or found * self.SPARSE <= hit.size:
                break
            # many pass: the least of whole matrices costs less than looking pairs up
            np.minimum(least, columns[f] @ rows[f].T, out=least)
        if not found:
            return
        if f == self.depth:
            yield from self._pass_on(least, hit, part, ids, None)
            return
        column, row, at = self._places(hit)
        least = least.ravel()[at]
        for g in range(f, self.depth):
            least = np.minimum(least, np.einsum("ij,ij->i", columns[g][column], rows[g][row]))
            kept = least > floor
            row, column, least = row[kept], column[kept], least[kept]
        yield from self._emit(row + part.start, column, least, ids, None)

    def _pass_on(self, product, hit, part, ids, f) -> Iterator[pa.RecordBatch]:
        """What is hit of a matrix of products (streamed row, row of the held part)."""
        column, row, at = self._places(hit)
        yield from self._emit(row + part.start, column, product.ravel()[at], ids, f)

    @staticmethod
    def _hit(product: np.ndarray, floor: float, ordered: np.ndarray | None) -> np.ndarray:
        hit = product > floor
        if ordered is not None:
            hit &= ordered
        return hit

    @staticmethod
    def _places(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, column, place in the flat matrix) of what is true, without a division for each."""
        lines, width = hit.shape
        at = np.flatnonzero(hit)
        line = np.repeat(np.arange(lines), np.diff(np.searchsorted(at, np.arange(lines + 1) * width)))
        return line, at - line * width, at

    def _compare_large(self, batch, ids, columns, part, rows, ordered) -> Iterator[pa.RecordBatch]:
        """As :meth:`_compare_part` for products of any size."""
        first = columns[0] @ rows[0].T
        # a rounded product may lie at the threshold; the exact one decides below
        floor = 0.0 if self.per_function else float(self.threshold)
        hit = self._hit(first, floor, ordered)
        if floor >= 2.0**53:
            hit |= (first >= floor) & (True if ordered is None else ordered)
        if self.per_function:
            for f in range(self.depth):
                product = columns[f] @ rows[f].T
                column, row, at = self._places(self._hit(product, 0.0, ordered))
                row += part.start
                product = product.ravel()[at].astype(np.float64)
                yield from self._emit(row, column, self._products(row, column, product, batch, f), ids, f)
            return
        # places in the flat matrix are found faster than rows and columns
        column, row, at = self._places(hit)
        least = self._products(row + part.start, column, first.ravel()[at].astype(np.float64), batch, 0)
        kept = (least > self.threshold).astype(bool)
        row, column, least = row[kept], column[kept], least[kept]
        for f in range(1, self.depth):
            if not len(row):
                return
            a, b = columns[f], rows[f]
            if len(row) * self.SPARSE > hit.size:
                product = (a @ b.T).ravel()[column * b.shape[0] + row]
            else:
                product = np.einsum("ij,ij->i", a[column], b[row])
            product = self._products(row + part.start, column, product.astype(np.float64), batch, f)
            least = np.minimum(least, product)
            kept = (least > self.threshold).astype(bool)
            row, column, least = row[kept], column[kept], least[kept]
        yield from self._emit(row + part.start, column, least, ids, None)

    def _emit(self, row, column, product, ids, f) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(row), FLUSH_ROWS):
            part = slice(at, at + FLUSH_ROWS)
            one, two = self.row_ids[row[part]], ids[column[part]]
            arrays = {
                "window_end": pa.array(np.full(len(one), self.window)),
                "sid1": pa.array(np.maximum(one, two), pa.int64()),
                "sid2": pa.array(np.minimum(one, two), pa.int64()),
            }
            if f is not None:
                arrays["f"] = pa.array(np.full(len(one), f, dtype=np.int32))
            whole = product[part]
            if whole.dtype == object:
                whole = [int(v) for v in whole]
                arrays["small"] = pa.array([v if v < 2**53 else None for v in whole], pa.int64())
                large = [None if v < 2**53 else decimal.Decimal(v) for v in whole]
                arrays["large"] = pa.array(large, pa.decimal128(38, 0))
            else:
                arrays["small"] = pa.array(whole.astype(np.int64))
                arrays["large"] = pa.nulls(len(whole), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_pydict(arrays)


class SketchListKernel(SketchKernel):
    """As above, in rows of lists: (window_end, f, own, other, small, large) with the partners
    of a streamed row in ``other`` and a value for each; ``large`` is null where none is.

    Pairs are many, and a row of its own for each costs far more on its way out of the
    task than the product.
    """

    SCHEMA = (
        "window_end bigint, f int, own bigint, other array<bigint>, small array<bigint>,"
        " large array<decimal(38,0)>"
    )

    def _emit(self, row, column, product, ids, f) -> Iterator[pa.RecordBatch]:
        # columns ascend: the pairs of a streamed row are together
        ends = np.searchsorted(column, np.arange(len(ids) + 1))
        begin = 0
        while begin < len(ids):
            end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + FLUSH_ROWS, "right")) - 1)
            end = min(end, len(ids))
            if ends[end] > ends[begin]:
                yield self._lists(row, product, ids, f, ends[begin : end + 1], begin)
            begin = end

    def _lists(self, row, product, ids, f, ends, begin) -> pa.RecordBatch:
        part = slice(ends[0], ends[-1])
        some = np.flatnonzero(np.diff(ends))
        offsets = pa.array(np.append(ends[some], ends[-1]) - ends[0], pa.int32())

        def lists(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(offsets, values)

        whole, large = product[part], pa.nulls(len(some), pa.list_(pa.decimal128(38, 0)))
        if whole.dtype == object:
            whole = [int(v) for v in whole]
            digits = [None if v < 2**53 else decimal.Decimal(v) for v in whole]
            large = lists(pa.array(digits, pa.decimal128(38, 0)))
            small = pa.array([v if v < 2**53 else None for v in whole], pa.int64())
        else:
            small = pa.array(whole.astype(np.int64))
        return pa.RecordBatch.from_pydict(
            {
                "window_end": pa.array(np.full(len(some), self.window), pa.int64()),
                "f": pa.array(np.full(len(some), f or 0, dtype=np.int32)),
                "own": pa.array(ids[begin + some], pa.int64()),
                "other": lists(pa.array(self.row_ids[row[part]], pa.int64())),
                "small": lists(small),
                "large": large,
            }
        )


class SketchGridKernel(SketchListKernel):
    """As above, in rows of grids: (window_end, f, owns, others, few, small, large) with a
    value for each of ``owns`` with each of ``others``, line by line, in one of the last three:
    32 bits, 64 bits or decimals; -1 where there is no pair.

    Where many pairs pass, neither looking up their places nor the names of the partners of
    each row is needed: a pair leaves the task as four bytes.  Few pairs are
    lists, as grids of one line.
    """

    # that names are not null is told to Spark, which then has less to do for a pair
    SCHEMA = StructType(
        [
            StructField("window_end", LongType(), False),
            StructField("f", IntegerType(), False),
            StructField("owns", ArrayType(LongType(), False), False),
            StructField("others", ArrayType(LongType(), False), False),
            StructField("few", ArrayType(IntegerType(), False)),
            StructField("small", ArrayType(LongType(), False)),
            StructField("large", ArrayType(DecimalType(38, 0), False)),
        ]
    )
    # Of a matrix with at least this share of pairs grids are made.
    SHARE = 0.6
    # The lines and columns of a grid; Spark holds the rows of all its pairs at once.
    LINES, COLUMNS = 16, 128

    def _pass_on(self, product, hit, part, ids, f) -> Iterator[pa.RecordBatch]:
        found = np.count_nonzero(hit)
        if found < self.SHARE * hit.size:
            yield from super()._pass_on(product, hit, part, ids, f)
            return
        whole = product if found == hit.size else np.where(hit, product, product.dtype.type(-1))
        others = self.row_ids[part]
        for left in range(0, len(others), self.COLUMNS):
            columns = slice(left, left + self.COLUMNS)
            width = len(others[columns])
            step = max(1, FLUSH_ROWS // (width * self.LINES)) * self.LINES
            for top in range(0, len(ids), step):
                values = whole[top : top + step, columns].astype(self._kind(whole))
                yield self._grids(ids[top : top + step], others[columns], values, f)

    @staticmethod
    def _kind(product: np.ndarray) -> type:
        return np.int32 if product.dtype == np.float32 else np.int64

    def _grids(self, owns, others, values, f) -> pa.RecordBatch:
        ends = np.append(np.arange(0, len(owns), self.LINES), len(owns))
        rows = len(ends) - 1
        return self._rows(
            f,
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(owns, pa.int64())),
            pa.ListArray.from_arrays(
                pa.array(np.arange(rows + 1) * len(others), pa.int32()),
                pa.array(np.tile(others, rows), pa.int64()),
            ),
            pa.array(ends * len(others), pa.int32()),
            pa.array(values.ravel()),
        )

    def _lists(self, row, product, ids, f, ends, begin) -> pa.RecordBatch:
        part = slice(ends[0], ends[-1])
        some = np.flatnonzero(np.diff(ends))
        offsets = pa.array(np.append(ends[some], ends[-1]) - ends[0], pa.int32())
        whole = product[part]
        if whole.dtype == object:
            values = pa.array([decimal.Decimal(int(v)) for v in whole], pa.decimal128(38, 0))
        else:
            values = pa.array(whole.astype(self._kind(whole)))
        return self._rows(
            f,
            pa.ListArray.from_arrays(
                pa.array(np.arange(len(some) + 1), pa.int32()), pa.array(ids[begin + some], pa.int64())
            ),
            pa.ListArray.from_arrays(offsets, pa.array(self.row_ids[row[part]], pa.int64())),
            offsets,
            values,
        )

    def _rows(self, f, owns, others, offsets, values) -> pa.RecordBatch:
        rows = len(owns)
        columns = {
            "window_end": pa.array(np.full(rows, self.window), pa.int64()),
            "f": pa.array(np.full(rows, f or 0, dtype=np.int32)),
            "owns": owns,
            "others": others,
        }
        for name, kind in (("few", pa.int32()), ("small", pa.int64()), ("large", pa.decimal128(38, 0))):
            given = values.type == kind
            columns[name] = pa.ListArray.from_arrays(offsets, values) if given else pa.nulls(rows, pa.list_(kind))
        return pa.RecordBatch.from_pydict(columns)


class SketchClassKernel(SketchKernel):
    """As above for streams of equal sketches: a row of a block is a sketch with the names of
    its streams in ``sids``, ``sid`` the least of them.

    One product stands for the pairs of all streams of two rows, and leaves the task in rows
    (window_end, f, owns, others, small, large): the value of each of ``owns`` with each of
    ``others``.  The streams of one row are pairs as well.
    """

    SCHEMA = StructType(
        [
            StructField("window_end", LongType(), False),
            StructField("f", IntegerType(), False),
            StructField("owns", ArrayType(LongType(), False), False),
            StructField("others", ArrayType(LongType(), False), False),
            StructField("small", LongType()),
            StructField("large", DecimalType(38, 0)),
        ]
    )
    # The most streams on the two sides of a row; Spark holds the rows of all its pairs at once.
    OWNS, OTHERS = 32, 64

    def _hold(self) -> None:
        super()._hold()
        self.row_sids, self.row_first, self.row_size = self._members(self.row_batch)

    @staticmethod
    def _members(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(streams, place of each row's first one, number of each row's)."""
        row, sids = list_column(batch, "sids")
        size = np.bincount(row, minlength=batch.num_rows)
        return sids, np.cumsum(size) - size, size

    def _compare(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        self.sids, self.first, self.size = self._members(batch)
        yield from super()._compare(batch)

    def _ordered(self, row_ids: np.ndarray, ids: np.ndarray) -> np.ndarray:
        own = (row_ids[None, :] == ids[:, None]) & (self.size > 1)[:, None]
        return own | super()._ordered(row_ids, ids)

    def _emit(self, row, column, product, ids, f) -> Iterator[pa.RecordBatch]:
        within = self.same_block & (self.row_ids[row] == ids[column])
        own = np.flatnonzero(within)
        if len(own):
            yield from self._within(column[own], product[own], f)
            kept = np.flatnonzero(~within)
            row, column, product = row[kept], column[kept], product[kept]
        lines, cuts = -(-self.size[column] // self.OWNS), -(-self.row_size[row] // self.OTHERS)
        for pair, at in self._dealt(lines * cuts, self.OWNS + self.OTHERS):
            held, past = row[pair], column[pair]
            line, cut = at // cuts[pair] * self.OWNS, at % cuts[pair] * self.OTHERS
            owns = self._lists(self.sids, self.first[past] + line, np.minimum(self.size[past] - line, self.OWNS))
            others = self._lists(
                self.row_sids, self.row_first[held] + cut, np.minimum(self.row_size[held] - cut, self.OTHERS)
            )
            yield self._rows(owns, others, product[pair], f)

    def _within(self, column, product, f) -> Iterator[pa.RecordBatch]:
        """The pairs of the streams of one row: each with those after it."""
        for pair, at in self._dealt(self.size[column] - 1, int(self.size.max())):
            past = column[pair]
            first = self.first[past] + at
            owns = self._lists(self.sids, first, np.ones_like(first))
            others = self._lists(self.sids, first + 1, self.size[past] - 1 - at)
            yield self._rows(owns, others, product[pair], f)

    @staticmethod
    def _dealt(rows: np.ndarray, names: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(pair, number among its rows) of so many rows for each pair, few enough at a time
        with so many names in a row."""
        ends = np.cumsum(rows)
        total, step = int(ends[-1]) if len(ends) else 0, max(1, FLUSH_ROWS // names)
        for begin in range(0, total, step):
            place = np.arange(begin, min(begin + step, total))
            pair = np.searchsorted(ends, place, "right")
            yield pair, place - (ends - rows)[pair]

    @staticmethod
    def _lists(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.ListArray:
        """Lists of neighbouring values."""
        ends = np.append(0, np.cumsum(size))
        place = np.repeat(first - ends[:-1], size) + np.arange(ends[-1])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[place], pa.int64()))

    def _rows(self, owns: pa.ListArray, others: pa.ListArray, product: np.ndarray, f) -> pa.RecordBatch:
        if product.dtype == object:
            whole = [int(v) for v in product]
            small = pa.array([v if v < 2**53 else None for v in whole], pa.int64())
            digits = [None if v < 2**53 else decimal.Decimal(v) for v in whole]
            large = pa.array(digits, pa.decimal128(38, 0))
        else:
            small, large = pa.array(product.astype(np.int64)), pa.nulls(len(product), pa.decimal128(38, 0))
        columns = {
            "window_end": pa.array(np.full(len(product), self.window), pa.int64()),
            "f": pa.array(np.full(len(product), f or 0, dtype=np.int32)),
            "owns": owns,
            "others": others,
            "small": small,
            "large": large,
        }
        return pa.RecordBatch.from_pydict(columns)
