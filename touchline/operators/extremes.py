"""Rows that hold the largest or smallest value, ties included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PICK = {"max": F.max, "min": F.min}


def extreme_rows(df: DataFrame, column: str, how: str = "max") -> DataFrame:
    """All rows whose ``column`` equals the extreme over ``df``.

    The extreme is one row, so it is broadcast and met with an equi-join. Both sides are parts of one
    plan: when ``df`` ends in an aggregate, both read the same shuffle output (``ReusedExchange``), the
    sources are scanned once and a hot key below is split once for both. A scalar subquery would say the
    same, but it is planned on its own: over finished stages it no longer splits hot keys.

    For the sharing to hold, give ``df`` just the columns that are used later, and no null in a column
    that is joined on later. The extreme is taken over whole rows, compared by ``column`` first, so that
    it needs the same columns as the answer.
    """
    known = df.filter(F.col(column).isNotNull())
    others = [c for c in df.columns if c != column]
    extreme = known.agg(_PICK[how](F.struct(column, *others))[column].alias(column))
    return known.join(F.broadcast(extreme), column, "left_semi").select(*df.columns)


def extreme_rows_by(df: DataFrame, column: str, keys: list[str], how: str = "max") -> DataFrame:
    """All rows whose ``column`` equals the extreme of their key group.

    An aggregate per key and a semi-join on key and value instead of a window: the aggregate combines
    on the map side, so a key with a large part of the rows is never gathered into one task. Rows with
    a null key or value are not returned.
    """
    extremes = df.groupBy(*keys).agg(_PICK[how](column).alias(column))
    return df.join(extremes, [*keys, column], "left_semi").select(*df.columns)
