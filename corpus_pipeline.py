"""From raw documents to a mixed corpus, stage by stage.

Each stage reads all that its predecessor kept, from Parquet in the shared folder,
so a lost executor costs no more than the tasks it had.  Stages but the last
return the columns of the documents; the last one returns the documents that the
mix takes words from, with the number of words.  Null and empty texts have no
language and go in the first stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepair.llm.common import table
from tidepair.llm.decontaminate import drop_contaminated
from tidepair.llm.exact_dedup import drop_duplicates
from tidepair.llm.language_id import drop_rejected, train
from tidepair.llm.mixing import taken_words
from tidepair.llm.ngram_join import drop_near_duplicates
from tidepair.session import materialize


def told_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language can not be told."""
    return drop_rejected(docs, train(docs))


def different_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return drop_duplicates(docs)


def different_shingles(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts, the document with the smallest id."""
    return drop_near_duplicates(docs)


def free_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that show a window of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of the documents in the mix."""
    return taken_words(docs).filter("taken > 0")


STAGES = [
    ("language_id", told_languages),
    ("exact_dedup", different_texts),
    ("ngram_join", different_shingles),
    ("decontamination", free_of_benchmarks),
    ("mixing", mixed_sources),
]

# Classification by compression and seeded permutations are not SQL: the tests hold
# the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
