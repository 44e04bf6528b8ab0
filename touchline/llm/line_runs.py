"""Removal of repeated lines by levelled sorted runs of line hashes.

Documents come in batches. The lines of a batch are added up to one row for each key: in how many documents it
stands, and the largest id of these. Keys that a run already counts in enough documents, under an id that is not
smaller, are settled: a merge anti-join with each run leaves them out of the batch, so that a frequent line costs
its batches nothing more. What is left of the batch becomes a run of its own, sorted by hash and bucketed by it, so
that a run is not shuffled again when it is joined. When a level holds ``fanout`` runs, they are compacted into one
run of the next level. After the last batch all runs together have the exact verdict on each key that matters.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import BitFilter, Plain, arrow_bytes, share, table, text_key
from touchline.session import durable_dir, shuffles_dropped, written

DOCUMENTS = 3
CHARACTERS = 20
BATCHES = 4
FANOUT = 2
_BLANK = b" \t\n\x0b\x0c\r"


class LineRuns:
    """Sorted runs of (h0, h1, documents, keep), by level."""

    def __init__(self, spark: SparkSession, documents: int = DOCUMENTS, fanout: int = FANOUT) -> None:
        if fanout < 2:
            raise ValueError("a level must hold two runs at least")
        self.spark, self.documents, self.fanout = spark, documents, fanout
        self.levels: list[list[DataFrame]] = []
        self.names: list[str] = []

    def _run(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        self.names.append(name)
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        with shuffles_dropped(self.spark):
            (
                rows.write.bucketBy(buckets, "h0", "h1")
                .sortBy("h0", "h1")
                .option("path", f"{durable_dir(self.spark)}/runs/{name}")
                .saveAsTable(name)
            )
        return self.spark.table(name)

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """Runs are merged pair by pair: with equal buckets on both sides, that takes no shuffle."""

        def merge(one: DataFrame, other: DataFrame) -> DataFrame:
            other = other.withColumnsRenamed({"documents": "more", "keep": "later"})
            both = F.coalesce("documents", F.lit(0)) + F.coalesce("more", F.lit(0))
            joined = one.join(other, ["h0", "h1"], "full_outer")
            return joined.select("h0", "h1", both.alias("documents"), F.greatest("keep", "later").alias("keep"))

        return reduce(merge, runs)

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (h0, h1, doc_id). All lines of a document must be in one batch."""
        new = lines.distinct().groupBy("h0", "h1").agg(F.count(F.lit(1)).alias("documents"), F.max("doc_id").alias("keep"))
        for run in self.runs:
            settled = run.where(F.col("documents") >= self.documents).select("h0", "h1", F.col("keep").alias("settled"))
            # a null id is the smallest one
            above = F.col("keep").isNull() | (F.col("settled") >= F.col("keep"))
            new = new.join(settled, (new["h0"] == settled["h0"]) & (new["h1"] == settled["h1"]) & above, "left_anti")
        self._put(0, self._run(new))

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._run(self._merged(full)))

    def close(self) -> None:
        """Forget the runs; their files stay in the durable folder."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names, self.levels = [], []

    def repeated(self) -> DataFrame | None:
        """(h0, h1, keep) of the keys in enough documents; None before the first batch."""
        if not self.runs:
            return None
        return self._merged(self.runs).where(F.col("documents") >= self.documents).select("h0", "h1", "keep")


def _key(line: bytes, characters: int) -> bytes | None:
    """The 128-bit hash of a line's key, if the key is long enough."""
    key = line.strip(_BLANK).lower()  # of bytes: only A-Z
    if len(key) < characters or (not key.isascii() and len(key.decode("utf-8", "replace")) < characters):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _lines(id_type: pa.DataType, characters: int, met=None):
    """The different keys of each row; with ``met``, those whose hash that filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = met() if met else None
        for batch in batches:
            keys, rows = [], []
            for row, text in enumerate(arrow_bytes(batch["text"])):
                own = {_key(line, characters) for line in text.split(b"\n")}
                own.discard(None)
                keys.extend(own)
                rows.append(np.full(len(own), row))
            h = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            if held is not None:
                found = held.may_hold(np.ascontiguousarray(h[:, 0]))
                h, row = h[found], row[found]
            same = pa.array(row.astype(np.int64))
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch[c].take(same) for c in names], *[pa.array(np.ascontiguousarray(c)) for c in h.T]], [*names, "h0", "h1"]
            )

    return run


def _kept(characters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, dropped, kept = [], [], []
            for text, gone in zip(arrow_bytes(batch["text"]), batch["gone"].to_pylist(), strict=True):
                lines = text.split(b"\n")
                stay = lines
                if gone:
                    keys = {np.array((g["h0"], g["h1"]), "<i8").tobytes() for g in gone}
                    stay = [line for line in lines if _key(line, characters) not in keys]
                counts.append(len(lines))
                dropped.append(len(lines) - len(stay))
                kept.append(b"\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_lines", "n_dropped", "kept"],
            )

    return run


def drop_repeated_lines(
    docs: DataFrame,
    documents: int = DOCUMENTS,
    characters: int = CHARACTERS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_lines, n_dropped, kept (the text without the dropped lines).

    Lines are split at ``\\n``; a null or empty text is one empty line. A line's key is the line without blanks
    (``[\\x20\\x09-\\x0D]``) at its ends and with A-Z in lower case. A key of at least ``characters`` code points that
    stands in at least ``documents`` documents loses all its lines but those in the document with the largest id.
    Rows that share an id are one document, whatever their texts; a null id is an id like the others, and the smallest.
    A line that repeats inside one document alone stays. An empty table gives an empty result. Other columns play no
    part. ``batches`` is the number of parts, by hash of the id, that the documents are added in; it doesn't change
    the result."""
    spark = docs.sparkSession
    plain = Plain(docs)
    rows = plain.df.select(
        F.col(plain[id_column]).alias("doc_id"), F.coalesce(F.col(plain[text_column]), F.lit("")).alias("text")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(_lines(id_type, characters), f"doc_id {id_type}, h0 long, h1 long")
    lines = written(found.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")))
    runs = LineRuns(spark, documents, fanout)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch).select("h0", "h1", "doc_id"))
    repeated = written(runs.repeated())
    runs.close()

    k0, k1 = text_key(F.col("text"))
    rows = rows.select("doc_id", k0.alias("k0"), k1.alias("k1"), "text")
    met = share(spark, BitFilter.of(repeated, "h0", repeated.count()))
    places = rows.mapInArrow(_lines(id_type, characters, met), f"doc_id {id_type}, k0 long, k1 long, h0 long, h1 long")
    places = places.join(repeated, ["h0", "h1"]).where(~F.col("doc_id").eqNullSafe(F.col("keep")))
    # equal rows have the same lines, so the set holds no more than one text's
    gone = places.groupBy("doc_id", "k0", "k1").agg(F.collect_set(F.struct("h0", "h1")).alias("gone"))
    gone = gone.withColumnsRenamed({"doc_id": "its_id", "k0": "its_k0", "k1": "its_k1"})
    same = (F.col("k0") == F.col("its_k0")) & (F.col("k1") == F.col("its_k1")) & F.col("doc_id").eqNullSafe(F.col("its_id"))
    held = rows.join(gone, same, "left").select("doc_id", "text", "gone")
    cut = held.mapInArrow(_kept(characters), f"doc_id {id_type}, n_lines long, n_dropped long, kept binary")
    return cut.withColumn("kept", cut["kept"].cast("string"))


def op13_levelled_line_dedup(spark, sf_dir) -> DataFrame:
    cut = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return cut.selectExpr("doc_id", "n_lines", "n_dropped", "sha2(kept, 256) AS kept_sha256")


OP13_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT doc_id, line, place, coalesce(doc_id <> keep, false) AS gone FROM keyed LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
