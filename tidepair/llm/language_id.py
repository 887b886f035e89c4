"""Language by compression: the language whose text helps most to compress a text.

One raw-content zstandard dictionary for each language is made of a bounded
sample of training rows.  A text is reduced to lower-case letters and spaces,
cut into blocks of ``CHUNK`` bytes so that its own history does not drown the
dictionary, and every block is encoded with every dictionary.  The smallest sum
wins; the margin to the second smallest is the score, and a text whose margin
is below ``NARROW`` is rejected.  Sums are whole bytes, so a margin is known up to
``DOUBT`` of them, which speak for the text: one rule for texts of all lengths.

Sample (documented bound): of each language the ``SAMPLE_TEXTS`` different texts with
the least hashes, and of each of these one fragment of ``FRAGMENT`` characters from a
place that its hash tells, anywhere in the text.  Fragments fill a dictionary of at
most ``DICTIONARY`` bytes.  Copies of a text count as one.
Predictions read whole texts and nothing but the text.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and
so is every text if there is nothing to learn from; with a single language
every text with letters is of it, with score 1; ties go to the language that
sorts first; rows without a language are not learned from.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out

UNKNOWN = "und"
DICTIONARY = 16_384
SAMPLE_TEXTS = 1_000
FRAGMENT = 512
CHUNK = 2_048
NARROW = 0.002
DOUBT = 1

# Lower-case ASCII letters and all bytes of other characters stay, the rest is blank.
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _parameters() -> zstd.ZstdCompressionParameters:
    return zstd.ZstdCompressionParameters(
        strategy=zstd.STRATEGY_LAZY, min_match=4, window_log=16, hash_log=14, chain_log=14, search_log=4,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )


def letters(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


def has_letter(text: str, reduced: bytes) -> bool:
    return bool(reduced) and (reduced.translate(None, bytes(range(128, 256))).strip() != b"" or any(map(str.isalpha, text)))


class Classifier:
    """Encoders by language.  Only the dictionaries travel to the tasks."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.dictionaries = dictionaries
        self.encoders = None

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "encoders": None}

    def sizes(self, reduced: bytes) -> list[int]:
        if self.encoders is None:
            parameters = _parameters()
            self.encoders = []
            for content in self.dictionaries.values():
                d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=parameters)
                self.encoders.append(zstd.ZstdCompressor(compression_params=parameters, dict_data=d))
        blocks = [reduced[i : i + CHUNK] for i in range(0, len(reduced), CHUNK)]
        return [sum(len(e.compress(b)) for b in blocks) for e in self.encoders]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, and whether the text is rejected."""
        reduced = letters(text or "")
        if not self.dictionaries or not has_letter(text or "", reduced):
            return UNKNOWN, 0.0, True
        ranked = sorted(zip(self.sizes(reduced), self.dictionaries, strict=True))
        if len(ranked) == 1:
            return ranked[0][1], 1.0, False
        (first, lang), (second, _) = ranked[:2]
        return lang, 1.0 - first / second, second - first + DOUBT < NARROW * second


def fragments(docs: DataFrame) -> DataFrame:
    """(lang, key, text): a fragment of each text of the sample; a text's copies have one key."""
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    key = F.xxhash64("text")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    # copies go in the map tasks; at most SAMPLE_TEXTS short rows of each language
    chosen = (
        known.select("lang", key.alias("key"))
        .distinct()
        .withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= SAMPLE_TEXTS)
    )
    place = F.pmod(F.xxhash64(F.lit(1), "key"), F.greatest(F.length("text") - FRAGMENT, F.lit(0)) + 1)
    return (
        known.withColumn("key", key)
        .join(F.broadcast(chosen), ["lang", "key"])
        .select("lang", "_n", F.substring("text", place.cast("int") + 1, F.lit(FRAGMENT)).alias("text"))
        .dropDuplicates(["lang", "_n"])
    )


def train(docs: DataFrame) -> Classifier:
    """Dictionaries from the rows that may be learned from."""
    samples: dict[str, dict[bytes, None]] = {}
    for row in sorted(fragments(docs).collect(), key=lambda r: (r["lang"], r["_n"])):
        if part := letters(row["text"]):
            samples.setdefault(row["lang"], {})[part] = None
    return Classifier({lang: b" ".join(texts)[:DICTIONARY] for lang, texts in samples.items()})


def identify_language(
    docs: DataFrame, classifier: Classifier, columns: list[str] | None = None
) -> DataFrame:
    """``columns`` of ``docs`` (default: all) with ``lang_pred``, ``score`` and ``rejected``.
    Columns of ``docs`` with one of these names are replaced."""
    added = ("lang_pred", "score", "rejected")
    keep = [c for c in (docs.columns if columns is None else columns) if c not in added]
    chosen = docs.select(*dict.fromkeys([*keep, "text"]))

    def predict(batches):
        for batch in batches:
            found = [classifier.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [
                    pa.array([f[i] for f in found], kind)
                    for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))
                ],
                names=[*keep, *added],
            )

    out = chosen.select(*keep).withColumns(
        {
            "lang_pred": F.lit(None).cast("string"),
            "score": F.lit(None).cast("double"),
            "rejected": F.lit(None).cast("boolean"),
        }
    )
    return chosen.mapInArrow(predict, out.schema)


def drop_rejected(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """The documents whose language is told, with their own columns."""
    plain = {c: f"_{i}" if c != "text" else c for i, c in enumerate(docs.columns)}
    found = identify_language(docs.select(*(F.col(c).alias(n) for c, n in plain.items())), classifier)
    return found.filter(~F.col("rejected")).select(*(F.col(n).alias(c) for c, n in plain.items()))
