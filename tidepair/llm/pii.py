"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Email, IP address, card and phone are the base spans.  The method adds bank
accounts (IBAN, confirmed by mod 97) and social security numbers.  Every span
has a prior score; a confirmed checksum and context words of its kind nearby
raise it, words that speak against it lower it.  Added spans are reported from
``REPORT`` on; base spans always.

Patterns run on UTF-8 bytes: all their classes are ASCII, so they match the
same spans; places are then told in characters.  Every pattern starts at a rare
character or at the first digit of a run, so long texts are read in linear time.

Defined cases: null counts as empty; repeated rows are separate rows; extra
columns are handed on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import chunks, code_points

# Fixed values of the contract.  A match of a digit pattern can not begin within a
# run of digits: it would have begun at the run's first digit.
LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(rb"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
BASE = ("email", "ip", "card", "phone")

IBAN = re.compile(rb"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(rb"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

CONTEXT = 60  # bytes on either side in which words count
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.6, "phone": 0.5, "iban": 0.6, "ssn": 0.3}
REPORT = 0.5
STEP = 0.2
FOR = {
    "email": (b"mail", b"contact"),
    "ip": (b"ip", b"address", b"host", b"server"),
    "card": (b"card", b"visa", b"credit", b"payment"),
    "phone": (b"phone", b"call", b"tel", b"mobile"),
    "iban": (b"iban", b"account", b"bank"),
    "ssn": (b"ssn", b"social security"),
}
AGAINST = (b"example", b"version", b"serial", b"order no", b"isbn")

_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def digits_of(text: bytes) -> bytes:
    return bytes(b for b in text if 48 <= b < 58)


def luhn(digits: bytes) -> bool:
    """Check digit of card numbers."""
    total = 0
    for i, b in enumerate(reversed(digits)):
        d = (b - 48) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(text: bytes) -> bool:
    """Check digits of bank accounts: moved to the end, letters as 10 to 35."""
    plain = text.replace(b" ", b"")
    if not 15 <= len(plain) <= 34:
        return False
    turned = (plain[4:] + plain[:4]).decode()
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(data: bytes) -> Iterator[tuple[int, int]]:
    """Local part to the left of each ``@``, domain to the right of it."""
    done, at = 0, data.find(b"@")
    while at >= 0:
        start = at
        while start > done and data[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(data, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = data.find(b"@", done)


def addresses(data: bytes) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(data):
        parts = [p.lstrip(b"0") for p in m[0].split(b".")]
        if all(len(p) <= 3 and int(p or b"0") <= 255 for p in parts):
            yield m.span()


def cards(data: bytes) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(data):
        digits = digits_of(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(data: bytes) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(data):
        if 10 <= len(digits_of(m[0])) <= 15:
            yield m.span()


def score(kind: str, data: bytes, start: int, end: int) -> float:
    """Prior, plus for a confirmed checksum, plus or less for words nearby."""
    near = data[max(0, start - CONTEXT) : start].lower() + b" " + data[end : end + CONTEXT].lower()
    value = PRIOR[kind] + (STEP if kind in ("card", "iban") else 0)
    value += STEP if any(w in near for w in FOR[kind]) else 0
    value -= STEP if any(w in near for w in AGAINST) else 0
    return round(min(1.0, max(0.0, value)), 6)


def document_spans(data: bytes, digits: int) -> list[tuple[str, int, int, float]]:
    """Spans in bytes with their scores; ``digits`` is the number of digits in ``data``."""
    found = [("email", *s) for s in emails(data)]
    if digits >= 4:
        found += [("ip", *s) for s in addresses(data)]
    if digits >= 14:
        found += [("card", *s) for s in cards(data)]
    if digits >= 10 and b"+" in data:
        found += [("phone", *s) for s in phones(data)]
    if digits >= 2:
        found += [("iban", *m.span()) for m in IBAN.finditer(data) if mod97(m[0])]
    if digits >= 9:
        found += [("ssn", *m.span()) for m in SSN.finditer(data)]
    scored = [(k, a, b, score(k, data, a, b)) for k, a, b in found]
    return [s for s in scored if s[0] in BASE or s[3] >= REPORT]


def scan_batch(texts: pa.Array) -> list[list[dict]]:
    out: list[list[dict]] = []
    for chunk in chunks(texts):
        sums = np.concatenate([[0], np.cumsum(_DIGITS[chunk.data])])
        digits = np.diff(sums[chunk.offsets]).tolist()
        raw, places = chunk.data.tobytes(), chunk.offsets.tolist()
        for row in range(chunk.last - chunk.first):
            data = raw[places[row] : places[row + 1]]
            spans = document_spans(data, digits[row])
            at = code_points(data, [p for _, a, b, _ in spans for p in (a, b)])
            out.append(
                [
                    {"kind": k, "start": at[2 * i], "end": at[2 * i + 1], "score": v}
                    for i, (k, _, _, v) in enumerate(spans)
                ]
            )
    return out


def scan_personal_data(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all) with ``found``: spans with kind and score."""
    keep = [c for c in (docs.columns if columns is None else columns) if c != "found"]
    chosen = docs.select(*dict.fromkeys([*keep, "text"]))

    def scan(batches):
        for batch in batches:
            found = pa.array(scan_batch(batch.column("text")), pa.list_(_SPAN))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [found], names=[*keep, "found"]
            )

    out = chosen.select(*keep).withColumn("found", F.lit(None).cast(SPANS))
    return chosen.mapInArrow(scan, out.schema)
