"""Season labels such as ``2012/2013``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def season_of(
    when: Column, cutover: int = 7, first_year: int | None = None, last_year: int | None = None
) -> Column:
    """Season a date falls in: up to month ``cutover`` it belongs to the season begun the year before.

    With ``first_year`` and ``last_year`` the labels are held within ``first/first+1`` ..
    ``last-1/last``, and a date outside these calendar years has no season.
    """
    year = F.year(when)
    start = year - F.when(F.month(when) <= cutover, 1).otherwise(0)
    if first_year is not None:
        start = F.greatest(start, F.lit(first_year))
    if last_year is not None:
        start = F.least(start, F.lit(last_year - 1))
    label = F.concat_ws("/", start.cast("string"), (start + 1).cast("string"))
    known = when.isNotNull()
    if first_year is not None:
        known = known & (year >= first_year)
    if last_year is not None:
        known = known & (year <= last_year)
    return F.when(known, label)
