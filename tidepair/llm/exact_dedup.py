"""Exact duplicates by salted combining, with whole texts compared at every stage.

1. Each task combines its own rows of equal (digest, salt, text): the partial
   aggregate before the first shuffle.  The salt is a hash of the document id.
2. Rows of one (digest, salt) meet and are merged by whole text.
3. The salt winners of a digest, at most ``SALTS`` for each text, meet and are
   merged by whole text.

So a text that fills a third of the corpus arrives in stage 2 as one row for
each task and salt, spread over the salts, and in stage 3 as ``SALTS`` rows.
Going back to the rows, (digest, salt) is the join key, so a hot text is spread
again, and adaptive execution can split what is still large.  Rows carry no
text there: a digest stands for its text, as stage 3 has seen that the digest
has a single one.  Digests with several texts are joined by digest and text.

Defined cases: a null text counts as empty; a null id loses against any other
and a group of null ids only keeps them all; rows that repeat an id and a text
share the decision; extra columns are ignored or, in ``drop_duplicates``, kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import BLANKS, whole_text

# Parts of a hot group.  The salts of a group are kept as bits of a bigint.
SALTS = 32

Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def normal_text(text: Column | str = "text") -> Column:
    """Every run of blanks as one space."""
    return F.regexp_replace(whole_text(text), BLANKS, " ")


def _salted(docs: DataFrame, digest: Digest) -> DataFrame:
    return (
        docs.select(F.col("doc_id").alias("_id"), normal_text().alias("_text"))
        .select(
            "_id",
            "_text",
            digest(F.col("_text")).alias("_digest"),
            F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int").alias("_salt"),
        )
    )


def _merged(rows: DataFrame) -> DataFrame:
    """One row for each text: local, salted and global combine."""
    salted = rows.groupBy("_digest", "_salt", "_text").agg(
        F.min("_id").alias("_keep"), F.count("*").alias("_size")
    )
    return (
        salted.repartition("_digest")
        .groupBy("_digest", "_text")
        .agg(
            F.min("_keep").alias("_keep"),
            F.sum("_size").alias("_size"),
            F.bit_or(F.expr("shiftleft(1L, _salt)")).alias("_salts"),
        )
    )


def duplicate_groups(docs: DataFrame, digest: Digest = sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``."""
    rows = _salted(docs, digest)
    texts = _merged(rows)
    groups = materialize(
        texts.groupBy("_digest").agg(
            F.count("*").alias("_texts"),
            F.min("_keep").alias("_keep"),
            F.sum("_size").alias("_size"),
            F.bit_or("_salts").alias("_salts"),
        ),
        "dedup",
    )
    spread = groups.filter("_texts = 1").select(
        "_digest",
        F.explode(
            F.filter(
                F.sequence(F.lit(0), F.lit(SALTS - 1)),
                lambda s: F.call_function("shiftright", F.col("_salts"), s).bitwiseAND(F.lit(1)) == 1,
            )
        ).alias("_salt"),
        "_keep",
        "_size",
    )
    found = rows.drop("_text").join(spread, ["_digest", "_salt"])
    clashing = groups.filter("_texts > 1").select("_digest")
    if not clashing.isEmpty():
        among = rows.join(clashing, "_digest", "left_semi")
        found = found.unionByName(
            among.join(_merged(among).drop("_salts"), ["_digest", "_text"]).drop("_text")
        )
    return found.select(
        F.col("_id").alias("doc_id"),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns of ``docs``.

    Of rows that repeat an id and a text one stays; which of them, where only
    other columns or blanks differ, is not defined.
    """
    keep = duplicate_groups(docs).filter("kept").select(
        F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_digest")
    )
    rows = docs.withColumn("_digest", sha256(normal_text()))
    return (
        rows.join(
            keep,
            rows["doc_id"].eqNullSafe(keep["_keep"]) & (rows["_digest"] == keep["_digest"]),
            "left_semi",
        )
        .dropDuplicates(["doc_id", "_digest"])
        .select(*docs.columns)
    )
