"""Exact deduplication by two passes over a Bloom filter, in DataFrame functions only.

Pass one writes the hash of every text into a filter of two bit arrays and keeps the cells that more than one
row has met. Pass two holds every row against it: a row of which either cell was met once is unique and goes
straight through; only the others are shuffled, by the SHA-256 of their whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import Plain, lower_ascii, table
from touchline.session import written

#: Words of 64 cells in each of the two bit arrays. The words that hold a repeated cell are broadcast: at most
#: this many of each array, 32 MB in all. With more rows than cells, more unique rows are shuffled too.
WORDS = 1 << 20


def _cells(h: Column, words: int) -> Column:
    """Where a hash lies in each array: word (the second array's words follow the first's) and bit."""
    second = F.xxhash64(h)
    return F.array(
        *[
            F.struct(
                (F.pmod(x, F.lit(words)) + i * words).cast("int").alias("word"),
                F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(x, 57).bitwiseAND(63).cast("int")).alias("bit"),
            )
            for i, x in enumerate((h, second))
        ]
    )


def repeated_cells(hashes: DataFrame, words: int = WORDS) -> DataFrame:
    """(word, again): the cells of the BIGINT column ``h`` that more than one row has met.

    Of a word's cells, ``bit_or`` are the met ones and those missing in ``bit_xor`` were met an even number of
    times. If that does not account for all rows, some cell was met three times or more, and all met cells of
    the word count as repeated. No repeated cell is left out."""
    cell = F.col("cell")
    met, odd, rows = F.col("met"), F.col("odd"), F.col("rows")
    even = met.bitwiseAND(F.bitwise_not(odd))
    surplus = rows - F.bit_count(met)
    return (
        hashes.select(F.explode(_cells(F.col("h"), words)).alias("cell"))
        .groupBy(cell["word"].alias("word"))
        .agg(F.bit_or(cell["bit"]).alias("met"), F.bit_xor(cell["bit"]).alias("odd"), F.count(F.lit(1)).alias("rows"))
        .where(surplus > 0)
        .select("word", F.when(surplus == F.bit_count(even), even).otherwise(met).alias("again"))
    )


def _decided(plain: Plain, id_column: str, text_column: str, words: int) -> DataFrame:
    doc_id, text = F.col(plain[id_column]), F.coalesce(F.col(plain[text_column]), F.lit(""))
    # lower() also lowers other letters than A-Z, so that it joins more texts and parts none that are equal.
    rows = plain.df.withColumn("h", F.xxhash64(F.lower(text)))
    # words is a bound on the rows of either side
    again = repeated_cells(rows.select("h"), words)
    first, second = (
        F.broadcast(again.select(F.col("word").alias(f"word{i}"), F.col("again").alias(f"again{i}"))) for i in (0, 1)
    )
    cells = _cells(F.col("h"), words)
    rows = rows.select("*", *[cells[i][k].alias(f"{v}{i}") for i in (0, 1) for k, v in (("word", "word"), ("bit", "bit"))])
    held = rows.join(first, "word0", "left").join(second, "word1", "left")
    possible = F.coalesce(
        (F.col("again0").bitwiseAND(F.col("bit0")) != 0) & (F.col("again1").bitwiseAND(F.col("bit1")) != 0), F.lit(False)
    )
    sha = F.sha2(lower_ascii(text), 256).alias("text_sha256")

    unique = held.where(~possible).select(
        *plain.columns,
        doc_id.alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        sha,
    )
    # Written once: the number that tells repeated rows apart is then the same for both readers.
    maybe = written(held.where(possible).select(*plain.columns, sha, F.monotonically_increasing_id().alias("number")))
    # A null id comes before all others, as in max().
    rank = F.struct(doc_id.alias("id"), F.col("number"))
    groups = maybe.groupBy(F.col("text_sha256").alias("group")).agg(
        F.max(rank).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    shuffled = maybe.join(groups, F.col("text_sha256") == F.col("group")).select(
        *plain.columns,
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("number") == F.col("keep.number")).alias("kept"),
        "text_sha256",
    )
    return unique.unionByName(shuffled)


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty one. Of equal texts the row
    with the largest id stays, a null id being the smallest; of rows that repeat id and text, one stays. An
    empty table gives an empty result. Other columns of ``docs`` play no part, whatever they are called."""
    plain = Plain(docs)
    decided = _decided(plain, id_column, text_column, words)
    return decided.select(
        F.col(plain[id_column]).alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"
    )


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``exact_groups``."""
    plain = Plain(docs)
    return plain.restore(_decided(plain, id_column, text_column, words).where("kept"))


def op7_exact_dedup(spark, sf_dir) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP7_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""
