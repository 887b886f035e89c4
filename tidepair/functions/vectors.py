"""Cosine similarity of two arrays, as an expression and as a SQL function."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0)))


def dot(x: Column, y: Column) -> Column:
    """Sum of products over the positions where both arrays have a value."""
    return _total(F.zip_with(x, y, lambda a, b: a * b))


def shared_square(x: Column, y: Column) -> Column:
    """Sum of squares of ``x`` over the positions where ``y`` has a value too."""
    return _total(F.zip_with(x, y, lambda a, b: F.when(b.isNotNull(), a * a)))


def cosine(x: Column, y: Column) -> Column:
    """Cosine over shared positions; null where one of the norms is zero."""
    norms = F.sqrt(shared_square(x, y)) * F.sqrt(shared_square(y, x))
    return F.try_divide(dot(x, y), norms)


def register_cosine(spark: SparkSession, name: str = "cosine_similarity") -> None:
    """Make :func:`cosine` callable from SQL text."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(x ARRAY<DOUBLE>, y ARRAY<DOUBLE>)
        RETURNS DOUBLE
        RETURN try_divide(
            aggregate(zip_with(x, y, (a, b) -> a * b), 0D, (s, v) -> s + coalesce(v, 0D)),
            sqrt(aggregate(zip_with(x, y, (a, b) -> if(b IS NULL, NULL, a * a)),
                           0D, (s, v) -> s + coalesce(v, 0D)))
            * sqrt(aggregate(zip_with(x, y, (a, b) -> if(a IS NULL, NULL, b * b)),
                             0D, (s, v) -> s + coalesce(v, 0D))))
        """
    )
