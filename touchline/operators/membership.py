"""Keeping rows by whether their key occurs elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_with(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``; never multiplies rows."""
    return df.join(other.select(*keys), keys, "left_semi")


def rows_within(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows of ``df`` whose key lies between the least and the greatest of ``other``; none if there are none. Both ends
    are subqueries of the plan. They reach the scan of a file, which passes over what lies outside: but for two
    aggregates, which the optimizer makes one whose parts no scan takes. So the greatest is a top one."""
    least = other.agg(F.min(other_key)).scalar()
    greatest = other.select(other_key).orderBy(F.desc_nulls_last(other_key)).limit(1).scalar()
    return df.filter(F.col(key).between(least, greatest))


def rows_without(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``.

    Null keys are dropped on both sides first. That gives the plain anti-join, which can shuffle,
    rather than the null-aware one of ``NOT IN``, which always broadcasts ``other``.
    """
    return _without_nulls(df, keys).join(_without_nulls(other.select(*keys), keys), keys, "left_anti")


def _without_nulls(df: DataFrame, keys: list[str]) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def present_in_all(df: DataFrame, entity: str, bucket: str, buckets: list) -> DataFrame:
    """Entities that have a row in every one of ``buckets`` (relational division): ``entity``."""
    wanted = set(buckets)
    return (
        df.filter(F.col(bucket).isin(*wanted))
        .groupBy(entity)
        .agg(F.count_distinct(bucket).alias("met"))
        .filter(F.col("met") == len(wanted))
        .select(entity)
    )
