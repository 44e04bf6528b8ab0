"""Dense surrogate ids 0..n-1 over a total order, inside one plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the number by which rows are ranked, and of those by which the buckets of each level are.
BITS = (20, 20)
#: Stands for the bucket of a null, below that of any number.
_NULL_BUCKET = -(1 << 63)


def dense_index(df: DataFrame, order: list[str], name: str, bits: tuple[int, ...] = BITS) -> DataFrame:
    """Number the rows of ``df`` in the order of ``order``, which must identify a row. Its last column is a whole
    number, the others say in which group a row is; nulls come first. Groups, such as seasons, must be few: the
    counts of all of them are sorted in one task.

    A number depends on the rows alone, so that plans that number the same rows agree, and nothing is run or written
    while planning. Rows fall into buckets by the number's upper bits, the buckets into larger ones, and these into
    groups. Every level is counted out of the one below; then, from the groups down, each bucket starts where its
    parent does, after the siblings before it. Last, a row is ranked inside its bucket. No window holds more than
    ``2**bits`` rows, but that of the largest buckets of one group, of which there are 2**24 at most."""
    *groups, key = order
    if any(c in df.columns for c in _own(len(bits))):
        raise ValueError(f"columns {_own(len(bits))} are taken")
    first = F.coalesce(F.shiftright(F.col(key).cast("bigint"), bits[0]), F.lit(_NULL_BUCKET))
    rows = df.withColumn("_bucket0", first)
    counts = [rows.groupBy(*groups, "_bucket0").agg(F.count(F.lit(1)).alias("_n"))]
    for level, wide in enumerate(bits[1:], 1):
        parent = F.shiftright(f"_bucket{level - 1}", wide).alias(f"_bucket{level}")
        counts.append(counts[-1].groupBy(*groups, parent).agg(F.sum("_n").alias("_n")))
    top = counts[-1].groupBy(*groups).agg(F.sum("_n").alias("_n"))
    starts = top.select(*groups, _before([], groups).alias("_start")) if groups else None
    for level in reversed(range(len(bits))):
        own = f"_bucket{level}"
        inside = list(groups)
        held = counts[level]
        if level + 1 < len(bits):
            inside.append(f"_bucket{level + 1}")
            held = held.withColumn(inside[-1], F.shiftright(own, bits[level + 1]))
        placed = held.select(*inside, own, _before(inside, [own]).alias("_before"))
        if starts is not None:
            placed = _joined(placed, starts, inside)
            start = F.col("_start") + F.col("_before")
        else:
            start = F.col("_before")
        starts = placed.select(*groups, own, start.alias("_start"))
    rank = F.row_number().over(Window.partitionBy(*groups, "_bucket0").orderBy(F.asc_nulls_first(key)))
    ranked = rows.withColumn("_rank", rank)
    numbered = _joined(ranked, starts, [*groups, "_bucket0"])
    return numbered.select(*df.columns, (F.col("_start") + F.col("_rank") - 1).alias(name))


def _own(levels: int) -> list[str]:
    return ["_n", "_start", "_before", "_rank", *(f"_bucket{i}" for i in range(levels))]


def _before(inside: list[str], order: list[str]) -> Column:
    """How many rows the siblings before a bucket hold."""
    window = Window.partitionBy(*inside).orderBy(*(F.asc_nulls_first(c) for c in order))
    return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _joined(rows: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join in which nulls are equal. It merges, so that numbered rows that are kept need no broadcast."""
    theirs = starts.withColumnsRenamed({c: f"_their_{c}" for c in keys})
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_their_{c}")) for c in keys))
    return rows.join(theirs.hint("merge"), same).drop(*(f"_their_{c}" for c in keys))
