"""Benchmark passages in documents, found by Wu-Manber search over words.

Test strings are windows of ``WINDOW`` consecutive words of an item, or the
whole of a shorter item.  For each length of window:

* a shift table over blocks of two words says how far a search may move on
  without passing the end of a test string;
* where it may not move, the hash of the last two words selects a bucket of
  test strings;
* their words are compared, first by hash, then byte by byte.

Documents are cut into stretches of words that are searched in step, so one
array operation moves all of them.

Different items are cut into pieces of ``PIECE_WORDS`` windows and dealt to blocks
by their running number of bytes, so a block has at most ``BLOCK_BYTES`` and one
piece.  A task builds the search tables of a block and writes them; the driver hands
on the tables of one block at a time, as bytes, and never sees items.  Each block is
searched for in all documents, with a table between blocks, so a task holds
the tables of one block however large the benchmark is.

Defined cases: null and wordless texts have no words and no hits; an item
without an id counts for hits but can not be named; repeated items are named
once; an empty benchmark finds nothing; other columns are handed on.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.prefix import with_running_total
from ..session import discard, materialize
from .textbytes import ALNUM, Words, chunks, mixed, words

WINDOW = 10
BLOCK_BYTES = 4 << 20
PIECE_WORDS = 4096
STRETCH = 256
SHIFT_BITS = 18

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Patterns(NamedTuple):
    """Different windows of one length and the search tables for them."""

    length: int
    hashes: np.ndarray  # of all words of the items, one after the other
    first: np.ndarray  # number of the first word of a window
    text: bytes  # all words, with one space after each
    begin: np.ndarray  # where a window is in ``text``
    end: np.ndarray
    names: list[str]
    item: np.ndarray  # places in ``names``, window after window
    items_from: np.ndarray  # where the items of a window begin in ``item``; one more at the end
    shift: np.ndarray
    suffixes: np.ndarray  # sorted hashes of the last words
    bucket: np.ndarray  # where the windows of a suffix begin in ``order``; one more at the end
    order: np.ndarray

    def spelt(self, window: int) -> bytes:
        return self.text[self.begin[window] : self.end[window]]

    def items(self, window: int) -> list[str]:
        return [self.names[i] for i in self.item[self.items_from[window] : self.items_from[window + 1]].tolist()]


def _block(hashes: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` (1 or 2) words that end at ``last``."""
    h = hashes[last]
    if size == 2:
        h = h + hashes[last - 1] * np.uint64(0x9E3779B97F4A7C15)
    return mixed(h)


def _slot(block: np.ndarray) -> np.ndarray:
    return (block >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)


def build_patterns(items: list[tuple[str | None, str | None]]) -> list[Patterns]:
    """Search tables for (id, text) items, by length of window."""
    hashes: list[np.ndarray] = []
    spelt: list[bytes] = []
    # the windows of each length, by their words: number of the first word, names
    found: dict[int, dict[bytes, tuple[int, set]]] = {}
    texts = pa.array([text for _, text in items], pa.string())
    for chunk in chunks(texts):
        w = words(chunk, ALNUM)
        raw = w.data.tobytes()
        before = len(spelt)
        hashes.append(w.hash)
        spelt += [raw[s:e] for s, e in zip(w.start.tolist(), w.end.tolist(), strict=True)]
        for row in range(chunk.last - chunk.first):
            a, b = before + int(w.first[row]), before + int(w.first[row + 1])
            length = min(WINDOW, b - a)
            name = items[chunk.first + row][0]
            for at in range(a, b - length + 1) if length else ():
                text = b" ".join(spelt[at : at + length])
                known = found.setdefault(length, {}).setdefault(text, (at, set()))
                if name is not None:
                    known[1].add(name)
    text = b"".join(word + b" " for word in spelt)
    begin = np.cumsum([0, *(len(word) + 1 for word in spelt)])
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return [_tables(n, flat, text, begin, list(w.values())) for n, w in sorted(found.items())]


def _tables(
    length: int, hashes: np.ndarray, text: bytes, begin: np.ndarray, windows: list[tuple[int, set]]
) -> Patterns:
    firsts = np.array([at for at, _ in windows], np.int64)
    size = min(2, length)
    shift = np.full(1 << SHIFT_BITS, length - size + 1, np.uint8)
    for at in range(size - 1, length):
        np.minimum.at(shift, _slot(_block(hashes, firsts + at, size)), np.uint8(length - 1 - at))
    suffix = _block(hashes, firsts + length - 1, size)
    order = np.argsort(suffix, kind="stable")
    suffixes, first = np.unique(suffix[order], return_index=True)
    names = sorted(set().union(*(known for _, known in windows)))
    number = {name: i for i, name in enumerate(names)}
    return Patterns(
        length,
        hashes,
        firsts,
        text,
        begin[firsts],
        begin[firsts + length] - 1,
        names,
        np.array([number[name] for _, known in windows for name in sorted(known)], np.int32),
        np.cumsum([0, *(len(known) for _, known in windows)]),
        shift,
        suffixes,
        np.append(first, len(order)),
        order,
    )


def _stretches(w: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last place where a window may end, for each stretch."""
    begin, stop = w.first[:-1] + length - 1, w.first[1:]
    parts = np.maximum(0, -(-(stop - begin) // STRETCH))
    row = np.repeat(np.arange(len(begin)), parts)
    part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    low = begin[row] + part * STRETCH
    return low, np.minimum(low + STRETCH, stop[row])


def candidates(w: Words, p: Patterns) -> np.ndarray:
    """Last words at which the shift table lets a window end."""
    size = min(2, p.length)
    at, stop = _stretches(w, p.length)
    out = []
    while len(at):
        move = p.shift[_slot(_block(w.hash, at, size))].astype(np.int64)
        out.append(at[move == 0])
        at = at + np.maximum(move, 1)
        inside = at < stop
        at, stop = at[inside], stop[inside]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def occurrences(w: Words, p: Patterns) -> Iterator[tuple[int, int]]:
    """(first word, window number) of every confirmed occurrence."""
    last = candidates(w, p)
    if not len(last):
        return
    suffix = _block(w.hash, last, min(2, p.length))
    place = np.minimum(np.searchsorted(p.suffixes, suffix), len(p.suffixes) - 1)
    known = p.suffixes[place] == suffix
    last, place = last[known], place[known]
    sizes = p.bucket[place + 1] - p.bucket[place]
    raw = w.data.tobytes()
    # so many places at once that their buckets hold about 100,000 windows
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(0, sizes.sum() + 100_000, 100_000))
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        n = sizes[i:j]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        window = p.order[np.repeat(p.bucket[place[i:j]], n) + within]
        first = np.repeat(last[i:j], n) - (p.length - 1)
        for k in range(p.length):
            same = w.hash[first + k] == p.hashes[p.first[window] + k]
            first, window = first[same], window[same]
        for a, b in zip(first.tolist(), window.tolist(), strict=True):
            spelt = b" ".join(
                raw[s:e]
                for s, e in zip(
                    w.start[a : a + p.length].tolist(), w.end[a : a + p.length].tolist(), strict=True
                )
            )
            if spelt == p.spelt(b):
                yield a, b


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def search_batch(batch: pa.RecordBatch, patterns: list[Patterns]) -> tuple[list, list, list]:
    """For each row: number of words, hit spans of words, ids of items."""
    counts: list[int] = []
    spans: list[list[tuple[int, int]]] = [[] for _ in range(batch.num_rows)]
    names: list[set] = [set() for _ in range(batch.num_rows)]
    for chunk in chunks(batch.column("text")):
        w = words(chunk, ALNUM)
        counts += np.diff(w.first).tolist()
        for p in patterns:
            for first, window in occurrences(w, p):
                row = int(np.searchsorted(w.first, first, "right")) - 1
                at = first - int(w.first[row])
                spans[chunk.first + row].append((at, at + p.length))
                names[chunk.first + row].update(p.items(window))
    return counts, spans, names


def cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, piece) of (item_id, text): words with one space between, at most
    ``PIECE_WORDS`` windows in a piece.  Each window of an item is whole in one piece."""
    for batch in batches:
        ids = batch.column("item_id").to_pylist()
        for chunk in chunks(batch.column("text")):
            w = words(chunk, ALNUM)
            raw = w.data.tobytes()
            names, pieces = [], []
            for row in range(chunk.last - chunk.first):
                a, b = int(w.first[row]), int(w.first[row + 1])
                for at in range(a, max(b - WINDOW + 1, min(a + 1, b)), PIECE_WORDS):
                    last = min(b, at + PIECE_WORDS + WINDOW - 1)
                    places = zip(w.start[at:last].tolist(), w.end[at:last].tolist(), strict=True)
                    names.append(ids[chunk.first + row])
                    pieces.append(b" ".join(raw[s:e] for s, e in places).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(pieces, pa.string())], names=["item_id", "piece"]
            )


def _block_tables(rows: pd.DataFrame) -> pd.DataFrame:
    pairs = zip(rows["item_id"], rows["piece"], strict=True)
    made = build_patterns([(None if pd.isna(name) else name, piece) for name, piece in pairs])
    return pd.DataFrame({"block": rows["block"].iloc[:1], "tables": [pickle.dumps(made, pickle.HIGHEST_PROTOCOL)]})


def search_tables(benchmark: DataFrame) -> DataFrame:
    """(block, tables): the search tables of each block of items, in a written table."""
    pieces = (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
        .mapInArrow(cut_items, "item_id string, piece string")
        .groupBy("item_id", "piece")
        .agg(F.max(F.octet_length("piece")).cast("long").alias("_bytes"))
    )
    # a piece has no zero byte, so the last one parts id and piece
    name = F.coalesce(F.concat(F.lit("="), "item_id"), F.lit("-"))
    keyed = pieces.withColumn("_key", F.sha2(F.concat(name, F.lit("\0"), "piece"), 256))
    placed = with_running_total(keyed, "_key", "_bytes", "_end")
    block = F.floor((F.col("_end") - F.col("_bytes")) / BLOCK_BYTES).alias("block")
    made = (
        placed.select("item_id", "piece", block)
        .groupBy("block")
        .applyInPandas(_block_tables, "block long, tables binary")
    )
    return materialize(made, "passages")


def find_passages(
    docs: DataFrame, benchmark: DataFrame, columns: list[str] | None = None
) -> DataFrame:
    """``columns`` of ``docs`` (default: all) with ``n_words``, ``spans`` (hit words,
    as disjoint stretches) and ``items`` (ids of items found, as sorted strings).
    Columns of ``docs`` with one of these three names are replaced."""
    spark = docs.sparkSession
    tables = search_tables(benchmark)
    blocks = sorted(r["block"] for r in tables.select("block").collect())
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", SPANS),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
    names = {field.name for field in added}
    wanted = [c for c in (docs.columns if columns is None else columns) if c.lower() not in names]
    out = docs.select(*dict.fromkeys([*wanted, "text"])).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in added}
    )
    schema = out.schema
    last = out.select(*wanted, *(f.name for f in added)).schema
    none = pickle.dumps([])
    before = None
    for block in blocks or [None]:
        made = none if block is None else bytes(tables.where(F.col("block") == block).first()["tables"])
        shared = spark.sparkContext.broadcast(made)
        is_last = not blocks or block == blocks[-1]
        given = last if is_last else schema

        def search(batches, shared=shared, keep=given.names[:-3]):
            patterns = pickle.loads(shared.value)
            for batch in batches:
                counts, spans, names = search_batch(batch, patterns)
                before = batch.column("spans").to_pylist()
                named = batch.column("items").to_pylist()
                spans = [
                    _merged(s + [(x["start"], x["end"]) for x in old or ()])
                    for s, old in zip(spans, before, strict=True)
                ]
                full = [[{"start": a, "end": b} for a, b in s] for s in spans]
                all_names = [sorted(n.union(old or ())) for n, old in zip(names, named, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in keep]
                    + [
                        pa.array(counts, pa.int64()),
                        pa.array(full, _ARROW_SPANS),
                        pa.array(all_names, pa.list_(pa.string())),
                    ],
                    names=[*keep, "n_words", "spans", "items"],
                )

        out = out.mapInArrow(search, given)
        if not is_last:
            out = materialize(out, "passages-found")
            shared.destroy()
            if before is not None:
                discard(before)
            before = out
    discard(tables)
    return out


def hit_words() -> F.Column:
    """Number of hit words from ``spans``."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any window of the benchmark, with their own columns."""
    plain = {c: f"_{i}" if c != "text" else c for i, c in enumerate(docs.columns)}
    found = find_passages(docs.select(*(F.col(c).alias(n) for c, n in plain.items())), benchmark)
    return found.filter(F.size("spans") == 0).select(*(F.col(n).alias(c) for c, n in plain.items()))
