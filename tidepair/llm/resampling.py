"""Documents drawn by importance, so that the sample looks like a target text.

Features are all runs of 1 to ``LONGEST`` words, in buckets by the CRC-32 of their
bytes.  The words of a document, joined by single spaces, are scanned once, and the
running CRC is kept before and after each word.  A CRC is linear over GF(2): that
of a run of words is the CRC up to its end, xor the CRC up to its beginning shifted
by the length of the run, so no run is ever hashed by itself.

1. Tasks count the features of all documents, and of all target texts, in
   ``BUCKETS`` buckets: at most that many short rows from each task.
2. The gain of a bucket is the logarithm of its smoothed share in the target over
   that among the documents.  ``BUCKETS`` numbers, so the table is broadcast.
3. The weight of a document is the sum of the gains of its features; a Gumbel
   variable derived from the id makes the highest scores a sample without
   replacement.  Ranks are running totals over ranges of the order, so that no
   task sees all rows.

Defined cases: null, empty and wordless texts have no features, weight 0 and no
rank; a null id hashes as empty text and comes first among ties; rows that repeat
an id are rows of their own and, alike in score too, take ranks one after another in any order;
an empty target has all counts 0; an empty table gives an empty result; columns of
``docs`` named like a result are replaced, others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepair.functions.prefix import with_running_total
from tidepair.session import discard, materialize

# Fixed values of the contract.
LONGEST = 3
BUCKETS = 10_000
PERCENT = 5
LEAST_WORDS = 20
SEED = 42
POLYNOMIAL = 0xEDB88320  # of CRC-32, lowest bit first

BLOCK_BYTES = 1 << 20  # bytes of text whose runs are looked at together
RESULTS = ("n_features", "n_words", "weight", "score", "rank")

# A-Z as a-z, 0-9, a-z and every byte of a character beyond ASCII as it is, others as a space.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def _byte_steps() -> np.ndarray:
    """What shifting a byte out of the register adds to it."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = (steps >> np.uint32(1)) ^ np.where(steps & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return steps


class Shifts:
    """Multiplication of CRCs by x^(8 n): what a CRC becomes n zero bytes later.

    A shift is linear, so it is the xor of four table entries, one for each byte of
    the CRC.  Lengths below ``SHORT`` have tables of their own; longer ones are put
    together from powers of two.
    """

    SHORT = 128

    def __init__(self):
        step = _byte_steps()
        self.step = step
        table = np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
        tables = []
        for _ in range(self.SHORT):
            tables.append(table)
            table = step[table & 255] ^ (table >> np.uint32(8))
        self.short = np.stack(tables)
        self.power = {}
        bit = self.SHORT.bit_length() - 1
        while bit < 48:
            self.power[bit] = table
            table, bit = self._apply(table, table), bit + 1

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = table[0][crc & 255]
        for k in (1, 2, 3):
            out = out ^ table[k][(crc >> np.uint32(8 * k)) & 255]
        return out

    def by(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        low = n & (self.SHORT - 1)
        out = self.short[low, 0, crc & 255]
        for k in (1, 2, 3):
            out ^= self.short[low, k, (crc >> np.uint32(8 * k)) & 255]
        high = np.flatnonzero(n >= self.SHORT)
        if len(high):
            for bit, table in self.power.items():
                some = high[(n[high] >> bit) & 1 == 1]
                if len(some):
                    out[some] = self._apply(table, out[some])
        return out

    def space(self, crc: np.ndarray) -> np.ndarray:
        """The CRCs after one more space."""
        inner = ~crc
        return ~(self.step[(inner ^ np.uint32(0x20)) & 255] ^ (inner >> np.uint32(8)))


_shifts: Shifts | None = None


def shifts() -> Shifts:
    """The tables, made once in each worker that needs them."""
    global _shifts
    if _shifts is None:
        _shifts = Shifts()
    return _shifts


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, list[bytes], bool]]:
    """(row, words, whether the row goes on) of each text, a long one in several pieces."""
    for row, text in enumerate(texts):
        rest = (text or "").encode().translate(_LETTERS)
        begin = 0
        while begin < len(rest):
            end = rest.find(b" ", begin + BLOCK_BYTES)
            end = len(rest) if end < 0 else end
            yield row, rest[begin:end].split(), end < len(rest)
            begin = end


def runs(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all runs of words, in blocks of about ``BLOCK_BYTES``."""
    words: list[bytes] = []
    rows: list[int] = []
    counts: list[int] = []
    size, old = 0, 0
    for row, more, unfinished in _pieces(texts):
        words += more
        rows.append(row)
        counts.append(len(more))
        size += sum(map(len, more))
        if size >= BLOCK_BYTES:
            of = np.repeat(rows, counts)
            yield _block(words, of, old)
            # the runs that begin in the last words of an unfinished text end in the next block
            old = min(LONGEST - 1, int((of == row).sum())) if unfinished else 0
            words = words[len(words) - old :]
            rows, counts, size = [row] * bool(old), [old] * bool(old), 0
    if words:
        yield _block(words, np.repeat(rows, counts), old)


def _block(words: list[bytes], row: np.ndarray, old: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the runs whose last word is not among the first ``old``."""
    move = shifts()
    after = np.fromiter(
        accumulate(words, lambda c, w: crc32(w, crc32(b" ", c)), initial=0), np.uint32, len(words) + 1
    )
    before, after = move.space(after[:-1]), after[1:]
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1)
    begin = end - length
    which, found = [], []
    for n in range(1, LONGEST + 1):
        first = np.arange(max(0, old - n + 1), len(words) - n + 1)
        first = first[row[first] == row[first + n - 1]]
        last = first + n - 1
        crc = after[last] ^ move.by(before[first], end[last] - begin[first])
        which.append(row[first])
        found.append((crc % np.uint32(BUCKETS)).astype(np.int64))
    return np.concatenate(which), np.concatenate(found)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str | None]]]:
    column = batch.column("text")
    for i in range(0, len(column), 1000):
        yield i, column[i : i + 1000].to_pylist()


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all rows of ``texts`` are in each bucket."""

    def count(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, some in _texts(batch):
                for _, bucket in runs(some):
                    counts += np.bincount(bucket, minlength=BUCKETS)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    sums = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = sums.toArrow()  # at most BUCKETS short rows
    out = np.zeros(BUCKETS, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What one feature adds to a weight, by bucket."""
    s, t = corpus.astype(float), target.astype(float)
    share = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``docs`` with n_features, n_words and weight in place of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    keep = [c for c in docs.columns if c != "text"]

    def weigh(batches):
        for batch in batches:
            n, weight = np.zeros((2, batch.num_rows), np.int64)
            for first, some in _texts(batch):
                for row, bucket in runs(some):
                    np.add.at(n, first + row, 1)
                    np.add.at(weight, first + row, shared.value[bucket])
            # n = w + (w - 1) + (w - 2) from two words on
            words = np.where(n > 2, (n + 3) // 3, (n > 0).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(n), pa.array(words), pa.array(weight)],
                names=[*keep, "n_features", "n_words", "weight"],
            )

    out = docs.select(*keep).withColumns({c: F.lit(0).cast("long") for c in ("n_features", "n_words", "weight")})
    return docs.mapInArrow(weigh, out.schema)


def gumbel(key: str = "doc_id", seed: int = SEED):
    """A Gumbel variable in thousandths, the same for the same key."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all but the text) with n_features, n_words,
    weight, score and rank.  The rank is null for the documents not drawn."""
    keep = [c for c in (docs.columns if columns is None else columns) if c not in (*RESULTS, "text")]
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = docs.select(*dict.fromkeys([*keep, "doc_id", "text"]))
    scored = materialize(
        weighted(rows, gain)
        .withColumn("score", F.col("weight") + gumbel())
        .withColumn("_may", (F.col("n_words") >= LEAST_WORDS).cast("long"))
        .withColumn("_row", F.monotonically_increasing_id()),
        "scored",
    )
    drawn = PERCENT * scored.agg(F.coalesce(F.sum("_may"), F.lit(0))).first()[0] // 100
    order = F.struct(-F.col("_may"), -F.col("score"), "doc_id", "_row")
    ranked = with_running_total(scored.withColumn("_order", order), "_order", "_may", "_rank")
    rank = F.when((F.col("_may") == 1) & (F.col("_rank") <= drawn), F.col("_rank"))
    out = ranked.withColumn("rank", rank.cast("long")).select(*keep, *RESULTS)
    discard(scored)  # the ranges have been written
    return out
