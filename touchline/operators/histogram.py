"""Frequency tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(
    df: DataFrame, column: str, keys: list[str] | None = None, weight: str | None = None, name: str = "n"
) -> DataFrame:
    """How often each non-null value of ``column`` occurs, per ``keys`` if given, for all keys at once.
    With ``weight`` a row stands for that many occurrences, so counted rows can be counted further."""
    occurrences = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        df.filter(F.col(column).isNotNull()).groupBy(*(keys or []), column).agg(occurrences.cast("bigint").alias(name))
    )
