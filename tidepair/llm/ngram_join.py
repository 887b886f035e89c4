"""Documents with nearly the same word shingles, by a grouped prefix join.

Two documents link when their sets of ``SHINGLE``-word shingles have a Jaccard
similarity of ``PERCENT`` or more; the result is the connected component of each.

1. Order of shingles.  Each task counts shingles in buckets and reports those far
   above its mean; of the shingles whose hash is in the lowest ``REGION`` it is also
   found which occur more than once.  Shingles that occur once come first, then
   others of the region, then the rest, frequent ones last.  Both tables have a
   bounded size and only order shingles: any order gives the same links, rare
   ones first gives few candidates.
2. Classes.  Equal sets are one class, by a 128-bit digest.  A class has a prefix:
   the shingles of which any linked set must share one.
3. Stars.  Of the classes that share one of their few smallest shingle hashes, a
   random one is the pivot and the others are verified against it.  A few rounds unite large
   groups of copies with work in proportion to their members; no pairs of a group
   are listed.  The texts of these classes are fetched once for all rounds, and new
   links are added to the stars of the rounds before.  This step only saves work.
4. Grouped prefix join.  Classes with equal size and prefix are one group.  Groups
   that share a prefix shingle (of the smaller one a shorter prefix will do, as its
   partner is no smaller), are not yet in one component, differ little
   enough in size and share enough of their prefixes are expanded to their
   members, and pairs of members in different components whose own bitmaps
   differ little enough are verified.  Groups of one member are compared by its
   bitmap before that.
   Pairs within one component need no proof, all others are looked at: no link
   between components is lost.

Verification reads whole texts again, and what agrees by hashes of words is compared
word by word before it is a link.  Hot pivots are dealt out in parts.

Defined cases: null and wordless texts have no shingles and are alone; a text of
fewer words is one shingle; the component of rows without any id is null; rows
that repeat an id are separate rows; extra columns are ignored or kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, materialize, shuffle_partitions
from .bitmap import Held, key_bits, may_hold
from .common import whole_text
from .components import contracted, labels, united
from .textbytes import LOWER, VISIBLE, Chunk, chunks, mixed, words

# Fixed values of the contract.
SHINGLE = 5
PERCENT = 80

BUCKET_BITS = 22
FAR_ABOVE = 4  # standard deviations above the mean of a task from which a bucket is reported
REGION = 0.35
PARITY = 2048
STAR_SHINGLES = 8
STAR_ROUNDS = 12
STAR_YIELD = 0.0005  # share of classes a round must link for another one to follow
PIVOT_PART = 512

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(chunk: Chunk) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    w = words(chunk, VISIBLE)
    h = w.hash
    rolled = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * _STEP + h[k : k + len(rolled)]
    rolled = mixed(rolled)
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(rolled[a : b - SHINGLE + 1])
        elif b > a:
            yield np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes())], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def frequent_levels(docs: DataFrame) -> np.ndarray:
    """For each bucket 0, or the power of two of its count if it stands out."""

    def count(batches):
        counts = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                for s in shingle_sets(chunk):
                    np.add.at(counts, _buckets(s), 1)
        mean = counts.mean()
        found = np.flatnonzero(counts > mean + FAR_ABOVE * (np.sqrt(mean) + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(counts[found])], names=["bucket", "n"]
        )

    found = (
        docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    ).toArrow()  # at most one short row for each bucket
    levels = np.zeros(1 << BUCKET_BITS, np.uint8)
    levels[found["bucket"].to_numpy()] = np.log2(found["n"].to_numpy()).astype(np.uint8)
    return levels


def _in_region(shingles: np.ndarray) -> np.ndarray:
    return shingles < np.uint64(int(REGION * 2**64))


def repeated_shingles(docs: DataFrame) -> DataFrame:
    """(token): the shingles of the region that occur in more than one text, at least.

    Tasks pass on their sorted distinct shingles in buckets, a list for each batch.
    """
    spark = docs.sparkSession
    buckets = 8 * shuffle_partitions(spark)

    def deal(batches):
        for batch in batches:
            sets = [s[_in_region(s)] for chunk in chunks(batch.column("text")) for s in shingle_sets(chunk)]
            flat = np.sort(np.concatenate([np.zeros(0, np.uint64), *sets]))
            # what a batch repeats is passed on twice
            first = np.flatnonzero(np.diff(flat, prepend=~flat[:1]))
            once = flat[first]
            again = once[np.diff(np.append(first, len(flat))) > 1]
            flat = np.concatenate([once, again])
            place = (mixed(flat) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            ends = np.searchsorted(place[order], np.arange(buckets + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), lists], names=["bucket", "tokens"])

    def repeats(batches):
        held, now = [], None

        def close():
            flat = np.sort(np.concatenate(held)) if held else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.unique(flat[1:][flat[1:] == flat[:-1]]))], names=["token"])

        for batch in batches:
            for bucket, tokens in zip(batch.column("bucket").to_pylist(), batch.column("tokens"), strict=True):
                if bucket != now:
                    yield close()
                    held, now = [], bucket
                held.append(tokens.values.to_numpy())
        yield close()

    dealt = docs.select("text").mapInArrow(deal, "bucket long, tokens array<long>").where("size(tokens) > 0")
    return (
        dealt.repartition(shuffle_partitions(spark), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(repeats, "token long")
    )


class Order(NamedTuple):
    """What is known of frequencies: levels of buckets, bits of repeated shingles."""

    levels: np.ndarray
    repeated: np.ndarray

    def star(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest hashes, frequent or not: near copies mostly share them, while
        the rare shingles that come first in a prefix are those of their differences."""
        return shingles[:STAR_SHINGLES]

    def prefix(self, shingles: np.ndarray) -> np.ndarray:
        """The first shingles in the common order: one more than a linked set may lack."""
        keep = len(shingles) - -(-PERCENT * len(shingles) // 100) + 1 if len(shingles) else 0
        known = np.where(_in_region(shingles), may_hold(self.repeated, shingles), 2)
        rank = self.levels[_buckets(shingles)] * np.uint8(4) + known.astype(np.uint8)
        return shingles[np.argsort(rank, kind="stable")[:keep]]


def shingle_order(docs: DataFrame) -> Order:
    repeated = materialize(repeated_shingles(docs), "repeated")
    order = Order(frequent_levels(docs), key_bits(repeated, "token"))
    discard(repeated)
    return order


def parity(shingles: np.ndarray) -> bytes:
    """For each of ``PARITY`` buckets, whether it has an odd number of shingles: two
    sets differ in at least as many shingles as their bitmaps in bits."""
    odd = np.bincount((shingles & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a 128-bit key of the text."""
    text = whole_text()
    return docs.withColumns({"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(1), text)})


def signatures(docs: DataFrame, order: Order) -> DataFrame:
    """(doc_id, k1, k2, n, d1, d2, bits, star, prefix) for each row, as a table: size,
    digest, parity bitmap, first shingles and prefix of its set."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def sign(batches):
        for batch in batches:
            n, digests, bitmaps, stars, prefixes = [], [], [], [], []
            for chunk in chunks(batch.column("text")):
                for s in shingle_sets(chunk):
                    n.append(len(s))
                    digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                    bitmaps.append(np.frombuffer(parity(s), np.int64))
                    stars.append(shared.value.star(s).view(np.int64))
                    prefixes.append(shared.value.prefix(s).view(np.int64))
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "k1", "k2")),
                    pa.array(n, pa.int64()),
                    pa.array(both[:, 0]),
                    pa.array(both[:, 1]),
                    *(_lists(x) for x in (bitmaps, stars, prefixes)),
                ],
                names=["doc_id", "k1", "k2", "n", "d1", "d2", "bits", "star", "prefix"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    lists = "bits array<long>, star array<long>, prefix array<long>"
    signed = keyed(docs.select("doc_id", "text")).mapInArrow(
        sign, f"doc_id {kind}, k1 long, k2 long, n long, d1 long, d2 long, {lists}"
    )
    signed = materialize(signed, "signatures")
    shared.destroy()
    return signed


def texts_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, text) of ``classes`` (cls, k1, k2), as a table."""
    keys = materialize(classes.select("cls", "k1", "k2"), "keys")
    held = Held(keys, "k1")
    texts = materialize(_matched(held.filter(keyed(docs.select("text")), "k1"), keys), "texts")
    held.close()
    discard(keys)
    return texts


def _matched(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """(cls, text) of the rows (text, k1, k2) that have a key.  Copies go in the map tasks, not
    all to the one key that they share."""
    return rows.dropDuplicates(["k1", "k2"]).join(keys, ["k1", "k2"]).select("cls", "text")


def word_shingles(text: bytes) -> set[tuple[bytes, ...]]:
    """The set of a text as words, to compare what agrees by hashes."""
    w = text.translate(_FOLDED).split(b" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + SHINGLE]) for i in range(max(1, len(w) - SHINGLE + 1))} if w else set()


_FOLDED = bytes(int(b) if VISIBLE[b] else 0x20 for b in LOWER)


def _linked(common: int, n: int, m: int) -> bool:
    return common > 0 and 100 * common >= PERCENT * (n + m - common)


def verified(texts: DataFrame, pairs: DataFrame, sets=shingle_sets) -> DataFrame:
    """The pairs (a, b) of classes that link, as a table.  ``pairs`` is a table; ``texts`` has
    (cls, text).  The text of ``a`` goes once to each part of its partners, the texts of
    the partners follow it.  ``sets`` gives the hashes that are compared first."""
    spark = pairs.sparkSession
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PIVOT_PART).alias("parts"))
    dealt = pairs.join(many, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")
    )
    pivots = many.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = (
        pivots.join(texts, pivots["a"] == texts["cls"])
        .select("a", "part", F.lit(None).cast("long").alias("b"), "text")
        .union(dealt.join(texts, dealt["b"] == texts["cls"]).select("a", "part", "b", "text"))
        .repartition(shuffle_partitions(spark), "a", "part")
        .sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    )

    def compare(batches):
        pivot, in_words, whole = np.zeros(0, np.uint64), None, b""
        for batch in batches:
            left, right = [], []
            ends = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
            for chunk in chunks(batch.column("text")):
                places = zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist(), strict=True)
                for s, (begin, end) in zip(sets(chunk), places, strict=True):
                    a, b = next(ends)
                    if b is None:
                        pivot, in_words, whole = s, None, chunk.data[begin:end].tobytes()
                        continue
                    common = len(np.intersect1d(pivot, s, assume_unique=True))
                    if not _linked(common, len(pivot), len(s)):
                        continue
                    in_words = word_shingles(whole) if in_words is None else in_words
                    other = word_shingles(chunk.data[begin:end].tobytes())
                    if _linked(len(in_words & other), len(in_words), len(other)):
                        left.append(a)
                        right.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    return materialize(rows.select("a", "b", "text").mapInArrow(compare, "a long, b long"), "links")


def _alike_in_size(n: Column, m: Column) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def _least_common(n: Column, m: Column) -> Column:
    """The least number of common shingles of linked sets of these sizes."""
    return F.ceil(PERCENT * (n + m) / (100 + PERCENT))


def _least_of_smaller(n: Column) -> Column:
    """The least number of its shingles that a set shares with a linked one of its size or larger."""
    return F.ceil(2 * PERCENT * n / (100 + PERCENT))


def _may_link(n: Column, m: Column, bits: Column, other: Column) -> Column:
    """Whether bitmaps differ in no more bits than linked sets of these sizes can."""
    odd = F.zip_with(bits, other, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(odd, F.lit(0), lambda s, x: s + x) <= n + m - 2 * _least_common(n, m)


def star_postings(classes: DataFrame) -> DataFrame:
    """(token, cls, n) for the first shingles that several classes share, as a table."""
    few = classes.select(F.explode("star").alias("token"), "cls", "n")
    shared = few.groupBy("token").count().filter("count > 1").select("token")
    return materialize(few.join(shared, "token", "left_semi"), "stars")


def star_pairs(postings: DataFrame, shown: DataFrame, edges: DataFrame | None, turn: int) -> DataFrame:
    """Pairs of a pivot and another class, of different components, that share one
    of the first shingles and have alike bitmaps; as a table.  ``shown`` has (cls, n, bits)."""
    placed = _placed(postings, edges)
    draw = F.xxhash64("cls", "token", F.lit(turn))
    lists = (
        placed.groupBy("token")
        .agg(
            F.min("comp").alias("_low"),
            F.max("comp").alias("_high"),
            *(F.min_by(c, draw).alias(f"_{c}") for c in ("cls", "comp", "n")),
        )
        .filter("_low < _high")
    )
    pairs = (
        placed.join(lists, "token")
        .filter((F.col("comp") != F.col("_comp")) & _alike_in_size(F.col("n"), F.col("_n")))
        .select(F.col("_cls").alias("a"), F.col("cls").alias("b"))
        .distinct()
    )
    return materialize(_with_alike_bitmaps(pairs, shown), "pairs")


def _with_alike_bitmaps(pairs: DataFrame, shown: DataFrame) -> DataFrame:
    left = shown.select(F.col("cls").alias("a"), F.col("n").alias("_n"), F.col("bits").alias("_bits"))
    right = shown.select(F.col("cls").alias("b"), "n", "bits")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter(_may_link(F.col("n"), F.col("_n"), F.col("bits"), F.col("_bits")))
        .select("a", "b")
    )


def prefix_pairs(placed: DataFrame) -> DataFrame:
    """Pairs of classes of different components whose groups pass the filters, as a table."""
    members = placed.select(
        "cls", "comp", "n", "bits", "prefix",
        F.xxhash64("n", "prefix").alias("g1"), F.xxhash64(F.lit(1), "n", "prefix").alias("g2"),
    )
    groups = members.groupBy("g1", "g2").agg(
        F.min("cls").alias("grp"),
        F.min("comp").alias("_low"),
        F.max("comp").alias("_high"),
        (F.count("*") == 1).alias("single"),
    )
    # a group with members of several components differs from every component
    groups = materialize(
        groups.select(
            "g1", "g2", "grp", "single",
            F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(-1 - F.col("grp")).alias("gcomp"),
        ),
        "groups",
    )
    shown = materialize(
        placed.join(groups.select(F.col("grp").alias("cls"), "gcomp", "single"), "cls").select(
            F.col("cls").alias("grp"), "gcomp", "n", "single", "bits", "prefix"
        ),
        "group-prefixes",
    )
    shared = materialize(
        shown.select("gcomp", F.explode("prefix").alias("token"))
        .groupBy("token")
        .agg(F.min("gcomp").alias("_low"), F.max("gcomp").alias("_high"))
        .filter("_low < _high")
        .select("token"),
        "shared",
    )
    held = Held(shared, "token")
    bits = held.shared
    head = ["grp", "gcomp", "n", "single", "bits"]

    def hold(batches):
        for batch in batches:
            lists = batch.column("prefix")
            flat = lists.flatten()
            size = np.diff(lists.offsets.to_numpy())
            keep = may_hold(bits.value, flat.to_numpy())
            row = np.repeat(np.arange(len(lists)), size)[keep]
            place = (np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size))[keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(row)) for c in head] + [flat.filter(pa.array(keep)), pa.array(place)],
                names=[*head, "token", "place"],
            )

    postings = shown.mapInArrow(
        hold, "grp long, gcomp long, n long, single boolean, bits array<long>, token long, place long"
    )
    postings = materialize(postings, "postings")
    held.close()
    discard(shown, shared)
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    n, m = x("n"), y("n")
    need = _least_common(n, m)
    # of linked sets the first common shingle is among the first of both: of the
    # smaller one among as many as it may lack of a partner that is no smaller
    first = postings.filter(F.col("place") <= F.col("n") - _least_of_smaller(F.col("n")))
    most = F.greatest(_least_of_smaller(n), F.ceil(m * PERCENT / 100))
    pairs = (
        first.alias("x")
        .join(
            postings.alias("y").hint("merge"),
            (x("token") == y("token"))
            & ((n < m) | ((n == m) & (x("grp") < y("grp"))))
            & (x("gcomp") != y("gcomp"))
            & _alike_in_size(n, m)
            & (~x("single") | ~y("single") | _may_link(n, m, x("bits"), y("bits"))),
        )
        .groupBy(x("grp").alias("grp"), y("grp").alias("_grp"))
        .agg(F.count("*").alias("common"), F.first(need - most + 1).alias("least"))
        .filter("common >= least")
        .select("grp", "_grp")
        .union(groups.filter("gcomp < 0").select("grp", F.col("grp").alias("_grp")))
    )
    of = members.join(groups.select("g1", "g2", "grp"), ["g1", "g2"])
    left = of.select("grp", *(F.col(c).alias(f"_{c}") for c in ("cls", "comp", "n", "bits")))
    right = of.select(F.col("grp").alias("_grp"), "cls", "comp", "n", "bits")
    pairs = (
        pairs.join(left, "grp")
        .join(right, "_grp")
        .filter(
            (F.col("_comp") != F.col("comp"))
            & ((F.col("grp") != F.col("_grp")) | (F.col("_cls") < F.col("cls")))
            & _may_link(F.col("n"), F.col("_n"), F.col("bits"), F.col("_bits"))
        )
        .select(F.col("_cls").alias("a"), F.col("cls").alias("b"))
    )
    pairs = materialize(pairs, "pairs")
    discard(groups, postings)
    return pairs


def _placed(classes: DataFrame, edges: DataFrame | None) -> DataFrame:
    """``classes`` with a class of the component of each."""
    if edges is None:
        return classes.withColumn("comp", F.col("cls"))
    at = labels(edges).withColumnRenamed("node", "cls")
    return classes.join(at, "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")


def star_links(docs: DataFrame, classes: DataFrame, total: int) -> DataFrame | None:
    """Edges towards the components that rounds of stars find, or None.  Each round writes
    three small tables: pairs, links, and the edges that take the place of the last ones."""
    postings = star_postings(classes)
    some = postings.select("cls").distinct()
    shown = materialize(classes.join(some, "cls", "left_semi").select("cls", "k1", "k2", "n", "bits"), "shown")
    texts = texts_of(docs, shown) if shown.count() else None
    edges = None
    for turn in range(STAR_ROUNDS if texts else 0):
        pairs = star_pairs(postings, shown, edges, turn)
        linked = verified(texts, pairs)
        new = linked.count()
        if new:
            edges = contracted(edges, linked)
        discard(pairs, linked)
        if new <= STAR_YIELD * total:
            break
    discard(postings, shown, *([texts] if texts else []))
    return edges if edges is None else united(edges)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, k1, k2), one row for each row of ``docs``."""
    signed = signatures(docs, shingle_order(docs))
    columns = ("n", "bits", "star", "prefix")
    classes = materialize(
        signed.filter("n > 0")
        .groupBy("d1", "d2")
        .agg(
            F.min("doc_id").alias("doc"),
            F.min(F.struct("k1", "k2")).alias("key"),
            *(F.first(c).alias(c) for c in columns),
        )
        .select(F.monotonically_increasing_id().alias("cls"), "d1", "d2", "doc", "key.*", *columns),
        "classes",
    )
    ids = materialize(signed.select("doc_id", "k1", "k2", "n", "d1", "d2"), "ids")
    discard(signed)
    edges = star_links(docs, classes, classes.count())
    pairs = prefix_pairs(_placed(classes, edges))
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    if pairs.count():
        texts = texts_of(docs, classes.join(ends, "cls", "left_semi"))
        linked = verified(texts, pairs)
        edges = united(contracted(edges, linked))
        discard(texts, linked)
    discard(pairs)
    last = _placed(classes.select("cls", "d1", "d2", "doc"), edges)
    names = last.groupBy("comp").agg(F.min("doc").alias("component_id"))
    named = last.join(names, "comp").select("d1", "d2", "component_id")
    some = ids.filter("n > 0").join(named, ["d1", "d2"])
    none = ids.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "k1", "k2"]
    return some.select(*columns).union(none.select(*columns))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id, with the columns of ``docs``."""
    keep = (
        near_duplicates(docs)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("_keep"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
    )
    text = whole_text()
    same = (
        docs["doc_id"].eqNullSafe(keep["_keep"])
        & (F.xxhash64(text) == keep["_k1"])
        & (F.xxhash64(F.lit(1), text) == keep["_k2"])
    )
    return docs.join(keep, same, "left_semi")
