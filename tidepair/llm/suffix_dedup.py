"""Repeated passages of a corpus, by sorting suffixes bucket by bucket.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else.

1. Buckets.  Every string of ``LENGTH`` bytes has an anchor: the place of its least
   hash of ``GRAM`` bytes, the last one on ties.  Equal strings have equal anchors at
   equal places, so suffixes need sorting only among those of one anchor hash.
   Consecutive strings with one anchor are a run; its bytes are its context.
2. Anchor hashes that occur once are left out before anything is shuffled that is
   larger than a hash.  Equal contexts are counted: a copied context is repeated
   as a whole and stays as one representative.
3. Deep-shallow sorting.  The contexts of a bucket are sorted by the suffix that
   begins at the anchor: multikey quicksort down to ``SHALLOW`` bytes, then a blind
   trie for each group that is still equal.  The longest common prefixes of
   neighbours tell how far strings agree to the right of the anchor; splitting the
   sorted bucket by the bytes to its left, longest agreement first kept, gives the
   strings that occur in another context.  All other suffixes of a run follow from
   the one at the anchor, so one suffix is sorted for each context.
4. A bucket of more than ``HOT`` different contexts is not gathered.  Its strings are
   halved by how many bytes before the anchor they begin: those of a half have more
   bytes in common than the anchor, and go to buckets by these.  What contexts have
   alike after the cut is one context.  Halves are halved again until a bucket is
   small, at the latest when it is one string, and are sorted as all others.
5. Repeated strings become spans of each text, and the rest of the text is kept.

Texts are known by a 128-bit key and contexts by a 128-bit digest, so copies are
worked on once.  Long texts are read in pieces that overlap.

Defined cases: null counts as empty; texts shorter than ``LENGTH`` bytes stay whole;
rows that repeat a text lose it all, if it is long enough; extra columns are
ignored or kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize, shuffle_partitions
from .bitmap import key_bits, may_hold
from .common import whole_text
from .textbytes import CHUNK_BYTES, chunks, mixed, powers

LENGTH = 200  # fixed value of the contract
GRAM = 32
SHALLOW = 64
HOT = 1024

_PLACES = LENGTH - GRAM + 1  # places of an anchor within a string
_LOW = np.uint64((1 << 20) - 1)
assert CHUNK_BYTES == 1 << 20


def anchored_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first string, number of strings, anchor, hash of the anchor) of the runs in a
    piece of at most ``CHUNK_BYTES`` bytes; strings lie within texts."""
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    up, down = powers()
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(data * up[:n], out=sums[1:])
    hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    least = (hashes & ~_LOW) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    span = 1
    while 2 * span <= _PLACES:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < _PLACES:
        least = np.minimum(least[: span - _PLACES], least[_PLACES - span :])
    end = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + LENGTH <= end)
    anchor = (_LOW - (least[at] & _LOW)).astype(np.int64)
    if not len(at):
        return at, at, anchor, anchor
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    return at[first], count, anchor[first], hashes[anchor[first]].view(np.int64)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, bytes, offsets): a chunk, or a long text in pieces that overlap."""
    if len(data) <= CHUNK_BYTES:
        yield 0, data, offsets
        return
    step = CHUNK_BYTES - LENGTH + 1
    for at in range(0, len(data) - LENGTH + 1, step):
        part = data[at : at + CHUNK_BYTES]
        yield at, part, np.array([0, len(part)])


_RUNS = "k1 long, k2 long, at long, strings int, anchor int, h long, c1 long, c2 long"
_NAMES = ["k1", "k2", "at", "strings", "anchor", "h", "c1", "c2"]


def keyed(docs: DataFrame) -> DataFrame:
    text = whole_text()
    return docs.select("*", F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


def runs(docs: DataFrame) -> DataFrame:
    """One row for each run: key of the text, first string, number of strings, place of
    the anchor after the first string, hash of the anchor, digest of the context."""

    def find(batches):
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("k1", "k2")]
            for chunk in chunks(batch.column("text")):
                for place, data, offsets in _pieces(chunk.data, chunk.offsets):
                    at, count, anchor, h = anchored_runs(data, offsets)
                    view = memoryview(data.tobytes())
                    digest = xxhash.xxh3_128_digest
                    c = np.frombuffer(
                        b"".join(
                            [digest(view[a:b]) for a, b in zip(at.tolist(), (at + count + LENGTH - 1).tolist(), strict=True)]
                        ),
                        np.int64,
                    ).reshape(-1, 2)
                    row = np.searchsorted(offsets, at, "right") - 1
                    columns = [
                        *(k[chunk.first + row] for k in keys),
                        at - offsets[row] + place,
                        count.astype(np.int32),
                        (anchor - at).astype(np.int32),
                        h,
                        c[:, 0],
                        c[:, 1],
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=_NAMES)

    return keyed(docs.select("text")).mapInArrow(find, _RUNS)


def filtered(df: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """The rows whose key may be in the set."""
    shared = df.sparkSession.sparkContext.broadcast(bits)

    def hold(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(shared.value, batch.column(column).to_numpy())))

    return df.mapInArrow(hold, df.schema)


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """A Patricia trie: inner nodes know the depth at which their strings part."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: tuple | list | None = None

    def add(self, i: int) -> None:
        """Go down by the bytes at the nodes only, compare with the string found
        there, then insert where the two part."""
        text = self.strings[i]
        if self.root is None:
            self.root = ([i],)
            return
        node = self.root
        while isinstance(node, list):
            depth, children = node
            byte = text[depth] if depth < len(text) else -1
            node = children.get(byte) or next(iter(children.values()))
        part = common(text, self.strings[node[0][0]])
        if part == len(text) == len(self.strings[node[0][0]]):
            node[0].append(i)
            return
        above, node = None, self.root
        while isinstance(node, list) and node[0] < part:
            above, step = node, text[node[0]] if node[0] < len(text) else -1
            node = node[1].get(step)
        leaf = ([i],)
        mine = text[part] if part < len(text) else -1
        if isinstance(node, list) and node[0] == part:
            node[1][mine] = leaf
            return
        if node is None:
            above[1][mine] = leaf
            return
        below = node
        while isinstance(below, list):
            below = next(iter(below[1].values()))
        other = self.strings[below[0][0]]
        fork = [part, {mine: leaf, (other[part] if part < len(other) else -1): node}]
        if above is None:
            self.root = fork
        else:
            above[1][step] = fork

    def order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out += node[0]
        return out


def deep_shallow_order(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Numbers of ``strings`` in ascending order of the strings."""
    out: list[int] = []
    stack = [list(range(len(strings)))]
    while stack:
        group = stack.pop()
        if len(group) == 1:
            out += group
            continue
        texts = [strings[i] for i in group]
        depth = common(min(texts), max(texts))  # multikey quicksort skips what is equal
        if depth >= shallow:
            trie = BlindTrie(strings)
            for i in group:
                trie.add(i)
            out += trie.order()
            continue
        parts: dict[int, list[int]] = {}
        for i in group:
            parts.setdefault(strings[i][depth] if depth < len(strings[i]) else -1, []).append(i)
        if -1 in parts:  # strings that end here are equal and come first
            ended = parts.pop(-1)
        else:
            ended = []
        stack += [parts[b] for b in sorted(parts, reverse=True)]
        stack += [[i] for i in reversed(ended)]
    return out


def repeated_strings(contexts: list[bytes], anchors: list[int], counts: list[int]) -> list[list[tuple[int, int]]]:
    """For each context, the (first, last) strings that occur in another one as well.

    ``anchors`` are the places of the common anchor, ``counts`` the numbers of strings.
    """
    right = [c[a:] for c, a in zip(contexts, anchors, strict=True)]
    left = [c[a - 1 :: -1] if a else b"" for c, a in zip(contexts, anchors, strict=True)]
    order = deep_shallow_order(right)
    shared = [common(right[i], right[j]) for i, j in zip(order, order[1:], strict=False)]
    found: list[list[tuple[int, int]]] = [[] for _ in contexts]
    # a class: members in order, agreement to the right of neighbours, least way to the left
    stack = [(order, shared, 0)]
    while stack:
        members, right_of, least = stack.pop()
        texts = [left[i] for i in members]
        way = common(min(texts), max(texts))
        for k, i in enumerate(members):
            best = max(right_of[k - 1] if k else 0, right_of[k] if k < len(right_of) else 0)
            # strings that begin so many bytes before the anchor
            low = max(least, LENGTH - best, anchors[i] - counts[i] + 1)
            high = min(way, anchors[i])
            if low <= high:
                found[i].append((anchors[i] - high, anchors[i] - low))
        parts: dict[int, tuple[list[int], list[int], int]] = {}
        for k, i in enumerate(members):
            if len(left[i]) > way:
                part = parts.setdefault(left[i][way], ([], [], k))
                if part[0]:
                    part[1].append(min(right_of[part[2] : k]))
                part[0].append(i)
                parts[left[i][way]] = (part[0], part[1], k)
        stack += [(m, r, way + 1) for m, r, _ in parts.values() if len(m) > 1]
    return found


_CONTEXTS = "h long, c1 long, c2 long, copies long, contexts long, anchor int, strings int, bytes binary"


def contexts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the ``wanted`` contexts, cut from the texts that show them."""
    places = materialize(
        wanted.groupBy("k1", "k2").agg(
            F.collect_list(F.struct("h", "c1", "c2", "copies", "contexts", "anchor", "strings", "at")).alias("found")
        ),
        "places",
    )
    texts = filtered(
        keyed(docs.select("text")).select(whole_text().alias("text"), "k1", "k2"), "k1", key_bits(places, "k1")
    )
    # copies of a text are cut once
    held = texts.dropDuplicates(["k1", "k2"]).join(places, ["k1", "k2"]).select("text", "found")

    def cut(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, found in zip(texts, batch.column("found"), strict=True):
                flat = pa.RecordBatch.from_struct_array(found.values)
                at = flat.column("at").to_pylist()
                count = flat.column("strings").to_pylist()
                cuts = [text[a : a + n + LENGTH - 1] for a, n in zip(at, count, strict=True)]
                names = ["h", "c1", "c2", "copies", "contexts", "anchor", "strings"]
                yield pa.RecordBatch.from_arrays(
                    [flat.column(c) for c in names] + [pa.array(cuts, pa.binary())], names=[*names, "bytes"]
                )

    return held.mapInArrow(cut, _CONTEXTS)


_SPANS = "array<struct<first:int,last:int>>"


def sorted_buckets(contexts: DataFrame, bucket: list[str], names: list[str]) -> DataFrame:
    """(``names``, spans): repeated strings of contexts, each bucket sorted in one task.
    Contexts with several copies are repeated whole and named elsewhere."""
    spark = contexts.sparkSession
    rows = contexts.repartition(shuffle_partitions(spark), *bucket).sortWithinPartitions(*bucket)

    def sort(batches):
        open_rows: list[tuple] = []
        out: list[tuple] = []

        def close():
            found = repeated_strings(*([r[k] for r in open_rows] for k in (-1, -3, -2)))
            for row, some in zip(open_rows, found, strict=True):
                if some and row[-4] == 1:
                    out.append((*row[len(bucket) : -4], [{"first": a, "last": b} for a, b in some]))

        def batch_of():
            columns = list(zip(*out, strict=True)) or [[]] * (len(names) + 1)
            kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            arrays = [pa.array(list(c), pa.int64()) for c in columns[:-1]] + [pa.array(list(columns[-1]), kind)]
            return pa.RecordBatch.from_arrays(arrays, names=[*names, "spans"])

        wanted = [*bucket, *names, "copies", "anchor", "strings", "bytes"]
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in wanted), strict=True):
                if open_rows and open_rows[0][: len(bucket)] != row[: len(bucket)]:
                    close()
                    open_rows = []
                open_rows.append(row)
            yield batch_of()
            out = []
        if open_rows:
            close()
        yield batch_of()

    return rows.mapInArrow(sort, "".join(f"{c} long, " for c in names) + f"spans {_SPANS}")


_PART = (
    "b1 long, b2 long, d1 long, d2 long, low int, high int, c1 long, c2 long, copies long, shift int, "
    "anchor int, strings int, bytes binary"
)


def halved(parts: DataFrame) -> DataFrame:
    """The two halves of ``parts``, by how many bytes before the anchor a string begins.

    All strings that begin ``low`` to ``high`` bytes before it contain the bytes from
    ``low`` before it on that are common to them; equal strings agree in these too.  So
    a half goes to a bucket (b1, b2) by their digest, with the digest (d1, d2) of what
    is left of the context, which many contexts may share.
    """

    def halve(batches):
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True)
            names = batch.schema.names
            out: list[tuple] = []
            for row in rows:
                r = dict(zip(names, row, strict=True))
                middle = (r["low"] + r["high"]) // 2
                for low, high in ((r["low"], middle), (middle + 1, r["high"])):
                    # strings i .. j begin anchor - i bytes before the anchor
                    first = max(0, r["anchor"] - high)
                    last = min(r["strings"] - 1, r["anchor"] - low)
                    if low > high or first > last:
                        continue
                    data = r["bytes"]
                    core = data[r["anchor"] - low : r["anchor"] - high + LENGTH]
                    mine = data[first : last + LENGTH]
                    bucket = digest(core + bytes((low, high)) + r["b1"].to_bytes(8, "big", signed=True))
                    ends = np.frombuffer(bucket + digest(mine), np.int64).tolist()
                    out.append(
                        (*ends, low, high, r["c1"], r["c2"], r["copies"], r["shift"] + first,
                         r["anchor"] - first, last - first + 1, mine)
                    )
            columns = list(zip(*out, strict=True)) or [[]] * len(_PART_KINDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, _PART_KINDS.values(), strict=True)],
                names=list(_PART_KINDS),
            )

    return parts.mapInArrow(halve, _PART)


_PART_KINDS = {
    name: {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[kind]
    for name, kind in (column.split() for column in _PART.split(", "))
}


def hot_spans(hot: DataFrame) -> list[DataFrame]:
    """Tables (c1, c2, spans) of the repeated strings of buckets that are too large for
    one task: halved until they are not, then sorted as all others.

    What contexts of a bucket have alike after a cut is one context of it with their
    copies; strings that all of them share are then one context alone.  In the end a
    bucket is one string and has one context, so this ends.
    """
    parts = hot.select(
        F.col("h").alias("b1"), F.lit(0).cast("long").alias("b2"), F.col("c1").alias("d1"), F.col("c2").alias("d2"),
        F.lit(0).alias("low"), F.lit(LENGTH - GRAM).alias("high"), "c1", "c2", "copies", F.lit(0).alias("shift"),
        "anchor", "strings", "bytes",
    )
    out = []
    before = None
    while parts is not None:
        parts = materialize(halved(parts), "halves")
        if before is not None:
            discard(before)
        before = parts
        kept = ("low", "high", "anchor", "strings")
        contexts = materialize(
            parts.groupBy("b1", "b2", "d1", "d2").agg(
                F.sum("copies").alias("copies"), *(F.first(c).alias(c) for c in kept), F.first("bytes").alias("bytes")
            ),
            "half-contexts",
        )
        sizes = contexts.groupBy("b1", "b2").agg(F.count("*").alias("contexts"))
        sized = contexts.join(sizes, ["b1", "b2"])
        # a copy of a whole context is repeated as it is; d1 and d2 name it within its bucket
        whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("strings") - 1).alias("last")))
        copied = sized.filter((F.col("copies") > 1) & (F.col("contexts") <= HOT)).select(
            "b1", "b2", "d1", "d2", whole.alias("spans")
        )
        few = sized.filter((F.col("contexts") > 1) & (F.col("contexts") <= HOT))
        found = copied.union(_sorted_halves(few))
        moved = F.transform(
            "spans",
            lambda s: F.struct((s["first"] + F.col("shift")).alias("first"), (s["last"] + F.col("shift")).alias("last")),
        )
        mine = parts.select("b1", "b2", "d1", "d2", "c1", "c2", "shift")
        out.append(
            materialize(mine.join(found, ["b1", "b2", "d1", "d2"]).select("c1", "c2", moved.alias("spans")), "half-spans")
        )
        large = materialize(sizes.filter(F.col("contexts") > HOT).select("b1", "b2"), "large")
        again = large.count() > 0
        parts = parts.join(large, ["b1", "b2"], "left_semi") if again else None
        discard(contexts)
    discard(before)
    return out


def _sorted_halves(few: DataFrame) -> DataFrame:
    """(b1, b2, d1, d2, spans) of the buckets of halves."""
    rows = few.select("b1", "b2", "d1", "d2", "copies", "anchor", "strings", "bytes")
    return sorted_buckets(rows, ["b1", "b2"], ["b1", "b2", "d1", "d2"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(k1, k2, spans): by key of text, the places (start, end) of its repeated bytes."""
    every = materialize(runs(docs), "runs")
    again = materialize(every.groupBy("h").count().filter("count > 1").select("h"), "anchors")
    some = materialize(filtered(every, "h", key_bits(again, "h")), "repeated-runs")
    discard(every, again)
    draw = F.xxhash64("k1", "k2", "at")
    known = materialize(
        some.groupBy("h", "c1", "c2").agg(
            F.count("*").alias("copies"),
            F.first("anchor").alias("anchor"),
            F.first("strings").alias("strings"),
            *(F.min_by(c, draw).alias(c) for c in ("k1", "k2", "at")),
        ),
        "contexts",
    )
    buckets = known.groupBy("h").agg(F.count("*").alias("contexts")).filter("contexts > 1")
    cut = materialize(contexts_of(docs, known.join(buckets, "h")), "context-bytes")
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("strings") - 1).alias("last")))
    found = known.filter("copies > 1").select("c1", "c2", whole.alias("spans"))
    found = found.union(sorted_buckets(cut.filter(F.col("contexts") <= HOT), ["h"], ["c1", "c2"]))
    hot = cut.filter(F.col("contexts") > HOT)
    if not hot.isEmpty():
        for more in hot_spans(hot):
            found = found.union(more)
    found = materialize(found, "found")
    discard(cut)
    place = F.transform(
        "spans",
        lambda s: F.struct(
            (F.col("at") + s["first"]).alias("start"), (F.col("at") + s["last"] + LENGTH).alias("end")
        ),
    )
    return (
        some.select("k1", "k2", "at", "c1", "c2")
        .distinct()  # of copies of a text
        .join(found, ["c1", "c2"])
        .select("k1", "k2", place.alias("spans"))
        .groupBy("k1", "k2")
        .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    )


def remaining(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left without the spans (sorted by start), and the number of maximal ones."""
    out, done, number = [], 0, 0
    reach = -1
    for start, end in spans:
        if start > reach:
            number += 1
            out.append(data[done:start])
        reach = max(reach, end)
        done = reach
    out.append(data[done:])
    return b"".join(out), number


_RESULT = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def without_repeats(docs: DataFrame, columns: list[str], kept_text: bool = False) -> DataFrame:
    """``columns`` of ``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and, if asked
    for, kept_bytes.  Texts without repeats are not shuffled."""
    spans = materialize(repeated_spans(docs), "spans")
    shared = docs.sparkSession.sparkContext.broadcast(key_bits(spans, "k1"))
    # under names of our own, as the table may use any
    plain = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(columns)), whole_text().alias("text"))
    rows = keyed(plain)
    names = [f"_{i}" for i in range(len(columns))]
    with_spans = rows.withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    head = with_spans.select(*names)
    added = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}
    if kept_text:
        added["kept_bytes"] = "binary"
    schema = head.withColumns({c: F.lit(None).cast(t) for c, t in added.items()}).schema

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        ends = batch.column("spans").to_pylist() if "spans" in batch.schema.names else [None] * len(texts)
        out: dict[str, list] = {c: [] for c in added}
        for text, some in zip(texts, ends, strict=True):
            left, number = remaining(text, [(s["start"], s["end"]) for s in some or ()])
            values = len(text), len(text) - len(left), number, hashlib.sha256(left).hexdigest(), left
            for c, v in zip(added, values, strict=False):
                out[c].append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in names] + [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=False)],
            names=[*names, *added],
        )

    def untouched(batches):
        for batch in batches:
            yield keep(batch.filter(pa.array(~may_hold(shared.value, batch.column("k1").to_numpy()))))

    def touched(batches):
        for batch in batches:
            yield keep(batch)

    clean = rows.mapInArrow(untouched, schema)
    some = filtered(rows, "k1", key_bits(spans, "k1")).join(spans, ["k1", "k2"], "left")
    cleaned = clean.union(some.mapInArrow(touched, schema))
    return cleaned.select(*(F.col(n).alias(c) for n, c in zip(names, columns, strict=True)), *added)
