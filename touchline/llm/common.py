"""Helpers of several operators: tables, column names, blocked bit filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


class Plain:
    """A DataFrame whose columns are called c0, c1, ..., so that an operator's own columns clash with none of
    them, whatever their names are. ``plain["text"]`` is the new name of a column; ``restore`` gives the
    caller's names back."""

    def __init__(self, df: DataFrame) -> None:
        self.names = list(df.columns)
        self.columns = [f"c{i}" for i in range(len(self.names))]
        self.df = df.toDF(*self.columns)

    def __getitem__(self, name: str) -> str:
        if name not in self.names:
            raise ValueError(f"no column {name!r} among {self.names}")
        return self.columns[self.names.index(name)]

    def restore(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(n) for c, n in zip(self.columns, self.names, strict=True)])


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is. Runs of capitals are lowered one by one, which
    takes half the time of ``translate``; a text without other letters than ASCII is lowered whole."""
    runs = F.regexp_extract_all(text, F.lit("[A-Z]+|[^A-Z]+"), F.lit(0))
    lowered = F.transform(runs, lambda run: F.when(run.between("A", "["), F.lower(run)).otherwise(run))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.array_join(lowered, ""))


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that stand for a text in joins."""
    return [F.xxhash64(text), F.xxhash64(F.lit(17), text)]


def arrow_bytes(column) -> list[bytes]:
    """The texts of an Arrow column as UTF-8, null as empty."""
    return [b"" if x is None else x for x in column.cast("binary").to_pylist()]


def share(spark: SparkSession, value):
    """A function that gives ``value`` on executors. Callers see to it that its size is bounded. It is packed here,
    so that workers need no copy of this folder to read it. Its arrays are read where they came in, not copied, and
    can't be written to."""
    arrays: list = []
    packed = cloudpickle.dumps(value, protocol=5, buffer_callback=arrays.append)
    held = spark.sparkContext.broadcast((packed, [x.raw().tobytes() for x in arrays]))
    return lambda: cloudpickle.loads(held.value[0], buffers=held.value[1])


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, for mapInArrow. When it ends, memory that Arrow keeps for later goes back: a worker lives on for other
    stages, and those of an executor share its memory."""

    def all_of(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return all_of


class BitFilter:
    """A Bloom filter of two bits in one 64-bit word for each key. Its size is bounded by ``max_words``; beyond
    that it lets more keys through that are not in it, and never loses one that is."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @classmethod
    def of(cls, keys: DataFrame, column: str, count: int, max_words: int = 1 << 21) -> BitFilter:
        """Of a BIGINT column. Spark sums up the words; the driver gets one row for each word at most."""
        n = 1 << 10
        while n < max_words and n < count // 2:
            n *= 2
        h = F.col(column)
        one = F.lit(1).cast("long")
        bits = F.call_function("shiftleft", one, F.shiftrightunsigned(h, 58).cast("int")).bitwiseOR(
            F.call_function("shiftleft", one, F.shiftrightunsigned(h, 52).bitwiseAND(63).cast("int"))
        )
        rows = (
            keys.select(h.bitwiseAND(n - 1).cast("int").alias("word"), bits.alias("bits"))
            .groupBy("word")
            .agg(F.bit_or("bits").alias("bits"))
            .toArrow()
        )
        words = np.zeros(n, np.uint64)
        words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        return cls(words)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.view(np.uint64)
        word = self.words[(keys & np.uint64(len(self.words) - 1)).astype(np.int64)]
        one = np.uint64(1)
        bits = (one << (keys >> np.uint64(58))) | (one << ((keys >> np.uint64(52)) & np.uint64(63)))
        return (word & bits) == bits


def sum_slices(parts: DataFrame, slices: int, dtype: type) -> list[np.ndarray]:
    """Add up the arrays in (slice INT, data BINARY), slice by slice, as they come in; the driver gets one array
    for each slice. Its size is that of the arrays, however many there are."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch["slice"].to_pylist(), batch["data"].to_pylist(), strict=True):
                array = np.frombuffer(data, dtype)
                sums[number] = sums[number] + array if number in sums else array
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums.keys(), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["slice", "data"]
        )

    rows = parts.repartition(slices, "slice").mapInArrow(run, "slice int, data binary").collect()
    return [np.frombuffer(r.data, dtype) for r in sorted(rows, key=lambda r: r.slice)]
