"""Vectors as short codes: one index for each of ``PARTS`` parts, by resident Lloyd rounds.

Components become integers, ``floor(SCALE * x)``, so every sum and distance is exact
and no result depends on the order of rows.

1. The parts of all vectors are dealt once to owners (position, entry, salt), in
   blocks.  The salts divide the members of an entry, so that no owner holds more
   than about ``OWNER_ROWS`` of a position however many vectors are alike.
2. In each round the owners add up their resident members, and the sums of the salts
   of an entry meet in one short row.  Owners then look for the nearest
   new entry of their members: those that keep theirs stay where they are, in the
   same partition, and only the others go through the next shuffle.  A partitioner
   known to both sides makes their union a narrow one.
3. Codebooks (``PARTS`` times ``ENTRIES`` parts, whatever the number of rows) go to
   all tasks.  Vectors are encoded in one pass.

Residents are kept on the executors' disks between rounds and written to the
checkpoint folder every ``CHECKPOINT_ROUNDS``; what a lost executor had is read from
there or made again.

Defined cases: vectors that are null or empty or hold null or non-finite components
are dropped, and so are those whose length is not that of the kept vector with the
smallest id; of equal ids the smaller vector comes first, null ids come last.  Part
``p`` of ``n`` components is ``p * n // PARTS`` to ``(p + 1) * n // PARTS``.  Fewer than
``ENTRIES`` vectors make that many entries.  An error beyond a long is null.  Rows
that repeat an id are rows of their own; other columns are ignored or kept; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepair.session import materialize, scratch_root, shuffle_partitions

# Fixed values of the contract.
SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6

OWNER_ROWS = 1 << 12
CHECKPOINT_ROUNDS = 3
STRIP = 4096  # rows whose distances are held at once
EXACT = 1 << 53  # whole numbers up to here are exact as doubles
LONGEST = (1 << 63) - 1

Codebook = list[np.ndarray]  # for each position an array (entry, component) of Python integers


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """The rows whose vector holds finite components only, and at least one."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0) & ~bad)


def whole(values: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)``: 64-bit where sums of squares stay exact, else Python integers."""
    scaled = np.floor(values.astype(np.float64) * SCALE) if values.size else values.astype(np.float64)
    if scaled.size == 0 or np.abs(scaled).max() < 1 << 20:
        return scaled.astype(np.int64)
    # multiplied as whole numbers, as a double could overflow
    return np.array(
        [[int(x) * SCALE if x == int(x) else int(np.floor(x * SCALE)) for x in row] for row in values.astype(float).tolist()],
        object,
    ).reshape(values.shape)


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def bounds(width: int) -> list[tuple[int, int]]:
    return [(p * width // PARTS, (p + 1) * width // PARTS) for p in range(PARTS)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each row, ties to the lower entry."""
    which, far = np.zeros(len(x), np.int64), np.zeros(len(x), object)
    most = max((int(abs(v).max()) for v in (x, entries) if v.size), default=0)
    exact = 4 * max(1, x.shape[1]) * (most + 1) ** 2 < EXACT
    for i in range(0, len(x), STRIP):
        some = x[i : i + STRIP]
        if exact:
            a, c = some.astype(np.float64), entries.astype(np.float64)
            d = (a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)
            d = d.astype(np.int64)
        else:
            d = ((some.astype(object)[:, None, :] - entries[None]) ** 2).sum(axis=2)
        at = d.argmin(axis=1)
        which[i : i + STRIP] = at
        far[i : i + STRIP] = d[np.arange(len(some)), at]
    return which, far


def packed(x: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes."""
    if x.dtype == object or not x.size:
        return x
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= x.min() and x.max() <= np.iinfo(kind).max:
            return x.astype(kind)
    return x


Block = tuple[int, np.ndarray]  # (owner, parts)


class Deal:
    """Numbers of owners: position, entry and salt as one integer."""

    def __init__(self, salts: int):
        self.salts = salts

    def owner(self, position: int, entry: int, salt: int) -> int:
        return (position * ENTRIES + entry) * self.salts + salt

    def place(self, owner: int) -> tuple[int, int, int]:
        rest, salt = divmod(owner, self.salts)
        return *divmod(rest, ENTRIES), salt


def _first_deal(rows: RDD, books: Codebook, deal: Deal, width: int, partitions: int) -> RDD:
    """The parts of all vectors at their first owners."""

    def blocks(batches) -> Iterator[Block]:
        task = TaskContext.get().partitionId()
        for turn, row in enumerate(batches):
            x = whole(np.frombuffer(row["vectors"], np.float64).reshape(-1, width))
            # a batch goes to one salt of an entry; batches of a task go round
            salt = (task * 7919 + turn) % deal.salts
            for p, (a, b) in enumerate(bounds(width)):
                part = x[:, a:b]
                entry, _ = nearest(part, books[p])
                for e in np.unique(entry).tolist():
                    yield deal.owner(p, e, salt), packed(part[entry == e])

    return rows.mapPartitions(blocks).partitionBy(partitions)


def _sums(residents: RDD, deal: Deal) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Members and component sums of each (position, entry)."""

    def own(blocks: Iterator[Block]):
        held: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for owner, x in blocks:
            at = deal.place(owner)[:2]
            # 64 bits hold the sums of a block of short numbers
            found = x.sum(axis=0, dtype=object if x.dtype == object else np.int64).tolist()
            held[at] = added(held[at], (len(x), found)) if at in held else (len(x), found)
        return held.items()

    def added(x, y):
        return x[0] + y[0], [a + b for a, b in zip(x[1], y[1], strict=True)]

    return residents.mapPartitions(own).reduceByKey(added).collectAsMap()


def _migrated(residents: RDD, books: Codebook, deal: Deal, partitions: int) -> RDD:
    """Members at the owners of their nearest entries.  Only those of another entry move."""

    def look(blocks: Iterator[Block], leaving: bool) -> Iterator[Block]:
        for owner, x in blocks:
            p, e, salt = deal.place(owner)
            entry, _ = nearest(x, books[p])
            if not leaving:
                stays = x[entry == e]
                if len(stays):
                    yield owner, stays
                continue
            for to in np.unique(entry[entry != e]).tolist():
                yield deal.owner(p, to, salt), x[entry == to]

    stay = residents.mapPartitions(lambda b: look(b, False), preservesPartitioning=True)
    move = residents.mapPartitions(lambda b: look(b, True)).partitionBy(partitions)
    return stay.union(move)


def train(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> tuple[Codebook, int]:
    """Codebooks fitted to all rows of ``vectors`` (usable ones), and the length of a vector."""
    spark = vectors.sparkSession
    first = vectors.select(key, F.col(column).cast("array<double>").alias("v")).orderBy(F.asc_nulls_last(key), "v").limit(1)
    width = next((len(r["v"]) for r in first.collect()), 0)
    if not width:
        return [], 0
    chosen = vectors.filter(F.size(column) == width).select(key, F.col(column).cast("array<double>").alias("v"))
    seeds = whole(np.array([r["v"] for r in chosen.orderBy(F.asc_nulls_last(key), "v").limit(ENTRIES).collect()]))
    books = [seeds[:, a:b].astype(object) for a, b in bounds(width)]
    deal = Deal(-(-chosen.count() // OWNER_ROWS))
    partitions = shuffle_partitions(spark)
    scratch_root(spark)  # a local session gets its checkpoint folder here

    def batches(arrow):
        for batch in arrow:
            x = matrix(batch.column("v"))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()] if len(x) else [], pa.binary())], names=["vectors"])

    rows = chosen.select("v").mapInArrow(batches, "vectors binary").rdd
    residents = _first_deal(rows, books, deal, width, partitions)
    before = None
    for turn in range(ROUNDS):
        if turn:
            residents = _migrated(residents, books, deal, partitions)
        residents = residents.persist(StorageLevel.DISK_ONLY)
        if turn % CHECKPOINT_ROUNDS == CHECKPOINT_ROUNDS - 1 and turn < ROUNDS - 1:
            residents.checkpoint()
        found = _sums(residents, deal)
        books = [book.copy() for book in books]
        for (p, e), (n, total) in found.items():
            books[p][e] = [s // n for s in total]
        if before is not None:
            before.unpersist()
        before = residents
    residents.unpersist()
    return books, width


def encoded(vectors: DataFrame, books: Codebook, width: int, column: str, columns: list[str]) -> DataFrame:
    """``columns`` of the usable rows with their code and error."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)  # PARTS * ENTRIES parts

    def encode(arrow):
        for batch in arrow:
            x = whole(matrix(batch.column("_v")) if len(batch) else np.zeros((0, width)))
            codes, errors = [], np.zeros(len(batch), object)
            for (a, b), book in zip(bounds(width), shared.value, strict=True):
                entry, far = nearest(x[:, a:b], book)
                codes.append(entry)
                errors = errors + far
            code = ["".join(f"{e:02x}" for e in row) for row in np.array(codes).T.tolist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(code, pa.string()),
                 pa.array([int(e) if e <= LONGEST else None for e in errors], pa.int64())],
                names=[*columns, "code", "error"],
            )

    chosen = vectors.filter(F.size(column) == width).select(*columns, F.col(column).cast("array<double>").alias("_v"))
    kinds = vectors.select(*columns).withColumns({"code": F.lit(""), "error": F.lit(None).cast("long")})
    return chosen.mapInArrow(encode, kinds.schema)


def codebooks_sha256(books: Codebook) -> str:
    return hashlib.sha256(",".join(str(int(c)) for book in books for entry in book for c in entry).encode()).hexdigest()


def compress(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of the usable vectors."""
    good = usable(vectors.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(column).alias("v")), "v")
    books, width = train(good, "v", "vec_id")
    if not width:
        good = good.limit(0)
    rows = materialize(encoded(good, books, width, "v", ["vec_id", "label"]), "codes")
    # one row for each label; a label that many rows have is a skewed side, split by adaptive execution
    sums = rows.groupBy(F.col("label").alias("_label")).agg(
        F.expr("try_cast(sum(cast(error AS decimal(38,0))) AS bigint)").alias("label_error")
    )
    return rows.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("vec_id").alias(key), "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")
    )
