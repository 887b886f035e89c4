"""What several operators for training text share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Space, tab, line feed, vertical tab, form feed, carriage return: fixed value of the contract.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# One quarter of the rows is never learned from: fixed values of the contract.
FOLDS, HELD_OUT = 4, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(text: Column | str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def held_out(key: Column | str = "doc_id", folds: int = FOLDS, remainder: int = HELD_OUT) -> Column:
    """True for the rows that no model may learn from.  A null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds == remainder


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
