"""Shuffled shards by a two-pass external shuffle, in DataFrame functions only.

Pass one scatters the records, by seeded hashes, into buckets that fit in memory; pass two shuffles each bucket
(Spark's ``shuffle`` is a Fisher-Yates shuffle) and writes it. A record's shard depends on its id and the number
of shards alone (rendezvous hashing), so that one more shard takes records only into itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import Plain, table
from touchline.session import written

SHARDS = 24
#: Bytes of text in a bucket, on average. One task holds one bucket at a time.
BUCKET_BYTES = 8 << 20
#: Rows of the table of bucket sizes up to which it is broadcast: 16 MB.
MAX_BROADCAST = 1 << 20


def _draw(record_id: Column, shard: Column, seed: int) -> Column:
    return F.xxhash64(record_id, shard.cast("long"), F.lit(seed).cast("long"))


def shard_of(record_id: Column, shards: int, seed: int = 0) -> Column:
    """The shard whose draw for this id is the highest."""
    draws = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(_draw(record_id, s, seed), s.alias("s")))
    return F.array_max(draws)["s"]


def grown_shard_of(record_id: Column, shard: Column, shards: int, seed: int = 0) -> Column:
    """The shard of this id when there is one more; ``shard`` is the one among ``shards``."""
    wins = _draw(record_id, F.lit(shards), seed) > _draw(record_id, shard, seed)
    return F.when(wins, F.lit(shards)).otherwise(shard)


def shuffled_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = 0,
    bucket_bytes: int = BUCKET_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` in their shards: (record, shard, slot), with ``record`` a struct of all columns of
    ``docs`` and ``slot`` the place in the shard, gapless from 0.

    The buckets are written to the shared folder and read back, so that the order is drawn once. Records are
    scattered over the buckets of a shard by id and a number of the row, so that no repeated row or id makes a
    large bucket. A null text takes part as an empty one; null ids share one shard; an empty table gives an
    empty result."""
    plain = Plain(docs)
    doc_id, text = F.col(plain[id_column]), F.col(plain[text_column])
    total = plain.df.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8)).first()[0] or 0
    per_shard = max(1, math.ceil(total / shards / bucket_bytes))

    number = F.monotonically_increasing_id()
    scattered = plain.df.select(
        *plain.columns, shard_of(doc_id, shards, seed).alias("shard"), number.alias("number")
    ).withColumn(
        "bucket",
        F.pmod(F.xxhash64(doc_id, F.col("number"), F.lit(seed + 1).cast("long")), F.lit(per_shard)).cast("int"),
    )
    record = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(plain.columns)])
    buckets = (
        scattered.repartition(shards * per_shard, "shard", "bucket")
        .groupBy("shard", "bucket")
        .agg(F.collect_list(F.struct("number", record.alias("record"))).alias("records"))
    )
    in_order = F.array_sort(
        "records", lambda a, b: F.when(a["number"] < b["number"], -1).when(a["number"] > b["number"], 1).otherwise(0)
    )
    placed = written(
        buckets.select("shard", "bucket", F.posexplode(F.shuffle(in_order, seed)).alias("place", "row")).select(
            "shard", "bucket", "place", F.col("row.record").alias("record")
        )
    )
    sizes = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    offsets = sizes.select(
        "shard",
        "bucket",
        F.expr("sum(rows) OVER (PARTITION BY shard ORDER BY bucket) - rows").alias("offset"),
    )
    if shards * per_shard <= MAX_BROADCAST:
        offsets = F.broadcast(offsets)
    names = F.struct(*[F.col(f"record.c{i}").alias(n) for i, n in enumerate(plain.names)])
    return placed.join(offsets, ["shard", "bucket"]).select(
        names.alias("record"), "shard", (F.col("offset") + F.col("place")).alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the result of ``shuffled_shards`` with one folder for each shard."""
    sharded.select("record.*", F.col("shard").alias("shard_number"), F.col("slot").alias("shard_slot")).write.partitionBy(
        "shard_number"
    ).parquet(path)


def op9_external_shuffle(spark, sf_dir) -> DataFrame:
    sharded = shuffled_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    doc_id, text, shard = F.col("record.doc_id"), F.col("record.text"), F.col("shard")
    return sharded.select(
        doc_id.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard.cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        grown_shard_of(doc_id, shard, SHARDS).cast("int").alias("grown_shard"),
    )
