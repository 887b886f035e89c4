"""Secrets in documents, told apart by how widely each is copied.

1. Patterns propose spans: assignments, access keys, long hexadecimal runs (the
   base spans), and long mixed tokens.
2. Over the whole corpus the value of each span is hashed and its distinct
   repositories and owners are counted, first per (hash, repository) and (hash,
   owner), so a value that a third of the documents quote is summed up by the
   map side and never gathered.
3. A value with few owners and repositories, mixed enough to be random, looks
   live; one that many owners show is an example.  Mixed tokens count as secrets,
   and so as spans, only if they look live.

Patterns run on UTF-8 bytes: all their classes are ASCII, so they match the same
spans; places are then told in characters.  Long runs of token characters are
found by array operations first, so prose costs no regular expression.

Defined cases: null counts as empty; rows that repeat an id are separate rows;
a null owner or repository is one of its own; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .textbytes import ANY, chunks, code_points

# Fixed values of the contract.
ASSIGN = re.compile(
    rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
SHORTEST = {"assign": 6, "access": 20, "hex": 24}
BASE = tuple(SHORTEST)

KEYWORDS = (b"passw", b"secret", b"token", b"api")
TOKEN = "token"
TOKEN_LENGTH = 20  # shortest run that is looked at; no base span but assignments is shorter
TOKEN_BITS = 3.5  # least entropy of a character for a value to look random
MOST_OWNERS = 2
MOST_REPOSITORIES = 20

_RUN = np.isin(ANY, np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", np.uint8))

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.binary()), ("random", pa.bool_())])
_SCHEMA = (
    "doc_id {id}, repository {repository}, owner {owner}, "
    "found array<struct<kind:string,start:bigint,end:bigint,value:binary,random:boolean>>"
)


def looks_random(value: bytes) -> bool:
    """Entropy of the characters above ``TOKEN_BITS``, with digits and letters."""
    counts = Counter(value).values()
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts)
    return bits >= TOKEN_BITS and any(48 <= b < 58 for b in value) and any(b >= 65 for b in value)


def base_spans(data: bytes, runs: list[tuple[int, int]]) -> Iterator[tuple[str, int, int, bytes]]:
    """Base spans in bytes.  ``runs`` are the runs of token characters in ``data`` of
    ``TOKEN_LENGTH`` or more: access keys and hexadecimal runs lie within one."""
    low = data.lower()
    if any(word in low for word in KEYWORDS):
        for m in ASSIGN.finditer(data):
            if len(m[1]) >= SHORTEST["assign"]:
                yield "assign", m.start(), m.end(), m[1]
    for a, b in runs:
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            for m in pattern.finditer(data, a, b):
                if len(m[0]) >= SHORTEST[kind]:
                    yield kind, m.start(), m.end(), m[0]


def document_spans(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[str, int, int, bytes]]:
    """Base spans and mixed tokens that no base span touches, in characters."""
    found = list(base_spans(data, runs))
    taken = [(a, b) for _, a, b, _ in found]
    for a, b in runs:
        if looks_random(data[a:b]) and not any(a < y and x < b for x, y in taken):
            found.append((TOKEN, a, b, data[a:b]))
    places = code_points(data, [p for _, a, b, _ in found for p in (a, b)])
    return [(k, places[2 * i], places[2 * i + 1], v) for i, (k, _, _, v) in enumerate(found)]


def long_runs(data: np.ndarray, offsets: np.ndarray, is_run: np.ndarray, shortest: int):
    """(row, start, end) of the runs of at least ``shortest`` bytes, ends exclusive, within rows."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_run[data]
    limit = np.zeros(len(data) + 1, bool)
    limit[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | limit))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | limit))
    long = end - start >= shortest
    start, end = start[long], end[long]
    row = np.searchsorted(offsets, start, "right") - 1
    return row, start - offsets[row], end - offsets[row]


def scan_batch(texts: pa.Array) -> list[list[dict]]:
    out: list[list[dict]] = []
    for chunk in chunks(texts):
        runs: dict[int, list[tuple[int, int]]] = {}
        for row, a, b in zip(*(x.tolist() for x in long_runs(chunk.data, chunk.offsets, _RUN, TOKEN_LENGTH)), strict=True):
            runs.setdefault(row, []).append((a, b))
        raw, places = chunk.data.tobytes(), chunk.offsets.tolist()
        for row in range(chunk.last - chunk.first):
            spans = document_spans(raw[places[row] : places[row + 1]], runs.get(row, []))
            out.append(
                [
                    {"kind": k, "start": a, "end": b, "value": hashlib.sha256(v).digest(), "random": looks_random(v)}
                    for k, a, b, v in spans
                ]
            )
    return out


def candidate_spans(docs: DataFrame, repository: str, owner: str) -> DataFrame:
    """(doc_id, repository, owner, found) for each document."""
    kinds = dict(docs.dtypes)

    def scan(batches):
        for batch in batches:
            found = pa.array(scan_batch(batch.column("text")), pa.list_(_SPAN))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(3)] + [found], names=["doc_id", "repository", "owner", "found"]
            )

    chosen = docs.select(
        F.col("doc_id"), F.col(repository).alias("repository"), F.col(owner).alias("owner"), "text"
    )
    return chosen.mapInArrow(
        scan, _SCHEMA.format(id=kinds["doc_id"], repository=kinds[repository], owner=kinds[owner])
    )


def ownership(spans: DataFrame) -> DataFrame:
    """(value, owners, repositories): distinct counts of each value over the corpus."""
    counts = [
        spans.select("value", F.col(c).alias("_who")).distinct().groupBy("value").agg(F.count("*").alias(name))
        for c, name in (("owner", "owners"), ("repository", "repositories"))
    ]
    return counts[0].join(counts[1], "value")


def scan_secrets(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """(doc_id, found): spans with their owners, repositories and class.

    ``found`` is an array of (kind, start, end, owners, repositories, live),
    sorted by start; mixed tokens that do not look live are left out.
    """
    each = materialize(
        candidate_spans(docs, repository, owner).withColumn("_row", F.monotonically_increasing_id()),
        "secrets",
    )
    spans = each.select("_row", "repository", "owner", F.explode("found").alias("s")).select(
        "_row", "repository", "owner", "s.*"
    )
    owned = ownership(spans)
    live = F.col("random") & (F.col("owners") <= MOST_OWNERS) & (F.col("repositories") <= MOST_REPOSITORIES)
    known = (
        spans.join(owned, "value")
        .withColumn("live", live)
        .filter((F.col("kind") != TOKEN) | F.col("live"))
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "owners", "repositories", "live"))).alias("_found"))
    )
    empty = F.array().cast(known.schema["_found"].dataType)
    return each.select("_row", "doc_id").join(known, "_row", "left").select(
        "doc_id", F.coalesce("_found", empty).alias("found")
    )
