"""Texts as UTF-8 bytes in numpy arrays: helpers that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 1 << 20

ANY = np.arange(256)
LOWER = np.where((ANY >= 0x41) & (ANY <= 0x5A), ANY + 32, ANY).astype(np.uint8)
# Lower-cased letters, digits and every byte of a character beyond ASCII.
ALNUM = ((ANY >= 0x30) & (ANY <= 0x39)) | ((ANY >= 0x61) & (ANY <= 0x7A)) | (ANY >= 0x80)
VISIBLE = ~((ANY == 0x20) | ((ANY >= 0x09) & (ANY <= 0x0D)))

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


@cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """The powers of a base and of its inverse modulo 2**64, made once in each process.

    They serve rolling hashes of a fixed length only: texts made for the purpose can
    clash, so what is found by them is compared as bytes.
    """
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        out = np.full(CHUNK_BYTES + 1, base, np.uint64)
        out[0] = 1
        both.append(np.cumprod(out))
    return both[0], both[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Chunk(NamedTuple):
    """Rows ``first`` to ``last`` of a batch; ``offsets`` are those of the rows in ``data``."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a column, null as empty, in runs of whole rows of about ``limit`` bytes."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(texts) == 0:
        return
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        begin = offsets[first]
        yield Chunk(first, last, data[begin : offsets[last]], offsets[first : last + 1] - begin)
        first = last


class Words(NamedTuple):
    """Words of a chunk: their hashes, places in the (lower-cased) bytes, and the
    number of the first word of each row."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray


def words(chunk: Chunk, is_word: np.ndarray) -> Words:
    data = LOWER[chunk.data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    limit = np.zeros(len(data) + 1, bool)
    limit[chunk.offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | limit))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | limit))
    return Words(
        _hashes(data, start, end), start, end, np.searchsorted(start, chunk.offsets), data
    )


LANE = 8
LONG_WORD = 256
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(LANE)] + [(1 << 64) - 1], np.uint64)


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words hashed by eights of bytes, mixed after each, all words at once; those of
    ``LONG_WORD`` bytes and more one by one.  Equally long words of up to eight bytes never clash."""
    size = end - start
    out = size.astype(np.uint64) * np.uint64(_BASE)
    padded = np.concatenate([data, np.zeros(LANE, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    left = np.flatnonzero(size < LONG_WORD)
    at = start[left]
    while len(left):
        rest = end[left] - at
        out[left] = mixed(out[left] ^ (lanes[at] & _KEEP[np.minimum(rest, LANE)]))
        more = rest > LANE
        left, at = left[more], at[more] + LANE
    for i in np.flatnonzero(size >= LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
    return out


def code_points(data: bytes, places: list[int]) -> list[int]:
    """Byte places, ascending or not, as numbers of characters."""
    if not places:
        return []
    if data.isascii():
        return list(places)
    leads = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(leads)])[np.asarray(places)].tolist()
