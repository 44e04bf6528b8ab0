"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

A shard is the index of a few megabytes of documents: for each term a list of (document, occurrences), compressed in
blocks of 128, with the last document and the largest impact of each block beside them. A query takes its terms'
lists by their upper bounds. Those whose bounds together stay below the least score that still counts are
non-essential: no document in them alone can be an answer, so candidates come from the other lists only. Before a
block of a non-essential list is decompressed, its maximum must leave a candidate the chance to get there. Each
task carries the best documents of a query from shard to shard, and what tasks have found is merged at the end.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from touchline.llm.common import Plain, arrow_bytes, share, table
from touchline.session import written

TOP = 10
BLOCK = 128
#: Bytes of text in a shard, and documents; a longer text is a shard of its own.
SHARD = 4 << 20
DOCUMENTS = 1 << 16
#: Characters of queries that are answered in one pass over the documents.
QUERIES = 4_000_000
#: Terms are the maximal runs of ASCII letters and digits and of all that is not ASCII, A-Z in lower case.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_KINDS = (np.uint8, np.uint16, np.uint32)


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERMS).split()


@dataclass(frozen=True)
class Corpus:
    """Counts over all documents: those with a term, and all terms with repeats."""

    documents: int
    terms: int

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        """The part of a score that grows with a document's length, in hundredths of the mean length."""
        if len(lengths) and int(lengths.max()) * 90 * self.documents >= 1 << 63:
            return np.array([10 + 90 * int(n) * self.documents // max(1, self.terms) for n in lengths], np.int64)
        return 10 + 90 * lengths * self.documents // max(1, self.terms)

    def weights(self, df: np.ndarray) -> np.ndarray:
        return np.floor(1000 * np.log((2 * self.documents + 2) / (2 * df + 1))).astype(np.int64)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = [len(terms(t)) for t in arrow_bytes(batch["text"])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([sum(n > 0 for n in lengths)], pa.int64()), pa.array([sum(lengths)], pa.int64())], ["documents", "terms"]
        )


@dataclass
class Shard:
    """``starts[i]``: the first block of the list of term ``terms[i]``; ``at``: where a block's bytes begin."""

    ids: list
    norms: np.ndarray
    terms: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    last: np.ndarray
    most: np.ndarray
    at: np.ndarray
    data: bytes

    def blocks(self, place: int) -> tuple[int, int]:
        return int(self.starts[place]), int(self.starts[place + 1])

    def read(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents of a block and their impacts."""
        a, n = int(self.at[block]), int(self.sizes[block])
        gap, tf = (_KINDS[k] for k in divmod(self.data[a], 4))
        gaps = np.frombuffer(self.data, gap, n, a + 1)
        times = np.frombuffer(self.data, tf, n, a + 1 + gaps.nbytes)
        documents = np.cumsum(gaps, dtype=np.int64) - 1
        return documents, impacts(times.astype(np.int64), self.norms[documents])

    def read_all(self, blocks) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.read(b) for b in blocks]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def impacts(tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * norms)


def _width(most: np.ndarray) -> np.ndarray:
    return (most > 0xFF).astype(np.int64) + (most > 0xFFFF)


def compress(corpus: Corpus, found: list[np.ndarray], lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """The lists of a shard. ``found`` has each document's terms by number, with repeats. Gives terms, df, starts,
    sizes, last, most, at and data."""
    n = len(found)
    norms = corpus.norms(lengths)
    document = np.repeat(np.arange(n), [len(x) for x in found])
    term = np.concatenate(found) if found else np.zeros(0, np.int64)
    pair, tf = np.unique(term.astype(np.int64) * max(1, n) + document, return_counts=True)
    term, document = pair // max(1, n), pair % max(1, n)
    some, begin, df = np.unique(term, return_index=True, return_counts=True)
    blocks = -(-df // BLOCK)
    starts = np.concatenate(([0], np.cumsum(blocks)))
    # where each block begins among the postings
    inside = np.arange(starts[-1]) - np.repeat(starts[:-1], blocks)
    first = np.repeat(begin, blocks) + inside * BLOCK
    until = np.minimum(first + BLOCK, np.repeat(begin + df, blocks))
    if not len(first):
        empty = np.zeros(0, np.int64)
        return some, df, starts, empty, empty, empty, empty, np.zeros(0, np.uint8)
    # the first gap of a block counts from before the first document, so that a block can be read alone
    gaps = np.diff(document, prepend=-1)
    gaps[first] = document[first] + 1
    most = np.maximum.reduceat(impacts(tf, norms[document]), first)
    kinds = [_width(np.maximum.reduceat(x, first)) for x in (gaps, tf)]
    at, data = [], bytearray()
    for a, b, gap, times in zip(first.tolist(), until.tolist(), *(k.tolist() for k in kinds), strict=True):
        at.append(len(data))
        data.append(gap * 4 + times)
        data += gaps[a:b].astype(_KINDS[gap]).tobytes()
        data += tf[a:b].astype(_KINDS[times]).tobytes()
    return some, df, starts, until - first, document[until - 1], most, np.array(at), np.frombuffer(bytes(data), np.uint8)


ARRAYS = ("norms", "terms", "df", "starts", "sizes", "last", "most", "at")


def _index(number, corpus: Corpus, id_type: pa.DataType):
    """One row for each shard."""

    def packed(ids: list, found: list[np.ndarray], lengths: list[int]) -> pa.RecordBatch:
        length = np.array(lengths, np.int64)
        some, df, starts, sizes, last, most, at, data = compress(corpus, found, length)
        arrays = (corpus.norms(length), some, df, starts, sizes, last, most, at)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(id_type)),
                *[pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in arrays],
                pa.array([data.tobytes()], pa.binary()),
            ],
            ["ids", *ARRAYS, "data"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number()
        ids, found, lengths, size = [], [], [], 0
        for batch in batches:
            for row, text in enumerate(arrow_bytes(batch["text"])):
                words = terms(text)
                if not words:
                    continue
                if size and (size + len(text) > SHARD or len(ids) == DOCUMENTS):
                    yield packed(ids, found, lengths)
                    ids, found, lengths, size = [], [], [], 0
                ids.append(batch["doc_id"].slice(row, 1))
                found.append(np.array([n for n in map(known.get, words) if n is not None], np.int64))
                lengths.append(len(words))
                size += len(text) + 1
        if ids:
            yield packed(ids, found, lengths)

    return run


class Best:
    """The best documents of a query so far."""

    def __init__(self, top: int) -> None:
        self.top, self.rows = top, []

    @property
    def least(self) -> int:
        """The least score that still counts; at an equal one, ids decide."""
        return -self.rows[-1][0] if len(self.rows) == self.top else 1

    def add(self, shard: Shard, documents: np.ndarray, scores: np.ndarray) -> None:
        if len(scores) > self.top:
            bar = np.partition(scores, -self.top)[-self.top]
            documents, scores = documents[scores >= bar], scores[scores >= bar]
        for d, score in zip(documents.tolist(), scores.tolist(), strict=True):
            # a document without id comes after all others
            row = (-score, shard.ids[d] is None, shard.ids[d] if shard.ids[d] is not None else 0)
            if score > 0 and (len(self.rows) < self.top or row < self.rows[-1]):
                bisect.insort(self.rows, row)
                del self.rows[self.top :]


def max_score(shard: Shard, query: list[tuple[int, int]], best: Best) -> dict[str, int]:
    """Put the documents of a shard that belong there into ``best``. ``query`` has a term's number and weight. Gives
    the number of blocks of the query's lists and of those that were decompressed."""
    lists = []
    for term, weight in query:
        place = int(np.searchsorted(shard.terms, term))
        if weight > 0 and place < len(shard.terms) and shard.terms[place] == term:
            a, b = shard.blocks(place)
            lists.append((weight * int(shard.most[a:b].max()), weight, a, b))
    counts = {"blocks": sum(b - a for _, _, a, b in lists), "read": 0}
    lists.sort()
    below = np.cumsum([0, *[bound for bound, *_ in lists]]).tolist()
    if not lists or below[-1] < best.least:
        return counts
    score = np.zeros(len(shard.ids), np.int64)

    def take(a: int, b: int, weight: int) -> None:
        counts["read"] += b - a
        documents, value = shard.read_all(range(a, b))
        score[documents] += weight * value

    # the list with the highest bound is essential in any case, and tells a first bar: that of its best documents
    left = len(lists) - 1
    take(lists[left][2], lists[left][3], lists[left][1])

    def bar() -> int:
        """A score that the last of the best is sure to reach."""
        least = best.least
        if len(score) >= best.top:
            least = max(least, int(np.partition(score, -best.top)[-best.top]))
        return max(1, least)

    # essential lists: no document of the others alone can get there
    while left and below[left] >= bar():
        left -= 1
        take(lists[left][2], lists[left][3], lists[left][1])
    candidates = np.flatnonzero(score)
    for bound, weight, a, b in reversed(lists[:left]):
        left -= 1
        least = bar()
        candidates = candidates[score[candidates] + bound + below[left] >= least]
        block = a + np.searchsorted(shard.last[a:b], candidates)
        within = block < b
        may_add = np.zeros(len(candidates), np.int64)
        may_add[within] = weight * shard.most[block[within]]
        promising = score[candidates] + may_add + below[left] >= least
        candidates, block, within = candidates[promising], block[promising], within[promising]
        wanted = np.unique(block[within])
        if len(wanted):
            counts["read"] += len(wanted)
            documents, value = shard.read_all(wanted.tolist())
            held = np.isin(documents, candidates, assume_unique=True)
            score[documents[held]] += weight * value[held]
    best.add(shard, candidates, score[candidates])
    return counts


def _search(queries, top: int, item_type: pa.DataType, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = queries()
        best = [Best(top) for _ in wanted]
        for batch in batches:
            for row in range(batch.num_rows):
                arrays = {c: np.frombuffer(batch[c][row].as_py(), np.int64) for c in ARRAYS if c != "df"}
                shard = Shard(ids=batch["ids"][row].as_py(), data=batch["data"][row].as_py(), **arrays)
                for (_, _, query), held in zip(wanted, best, strict=True):
                    max_score(shard, query, held)
        rows = [(n, item, None if r[1] else r[2], -r[0]) for (n, item, _), b in zip(wanted, best, strict=True) for r in b.rows]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        types = (pa.int64(), item_type, id_type, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query", "item_id", "doc_id", "score"]
        )

    return run


def _df(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            arrays = [np.frombuffer(batch[c][row].as_py(), np.int64) for c in ("terms", "df")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["term", "df"])


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[int, object, list[bytes]]]]:
    """The queries with their number, id and different terms, in blocks of about ``limit`` characters."""
    block, size = [], 0
    for n, row in enumerate(items.toLocalIterator()):
        text = (row["text"] or "").encode("utf-8", "replace")
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((n, row["item_id"], sorted(set(terms(text)))))
        size += len(text)
    if block:
        yield block


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    query_column: str = "text",
    block: int = QUERIES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each row of ``items``, of a score above 0.

    Terms are the maximal runs of what is neither ASCII punctuation, blank nor control character, with A-Z in lower
    case; a null text has none, and neither finds nor is found. With N documents that have a term, L terms in all, n
    in the document, tf of them the query's term, and df documents that hold it, the score adds up
    ``floor(1000 ln((2N+2)/(2df+1))) * (10**9 tf div (1000 tf + 8 (10 + 90 n N div L)))`` over a query's different
    terms. Equal scores are ranked by id, a null id last. Rows of documents that repeat are found each; each row of
    ``items`` is a query of its own, also where ids repeat. Without documents or terms the result is empty. Other
    columns play no part.

    Queries are taken in blocks of ``block`` characters; the driver and each task hold the terms of one block, and
    the documents are read once for a block."""
    spark = docs.sparkSession
    plain, asked = Plain(docs), Plain(items)
    rows = plain.df.select(F.col(plain[id_column]).alias("doc_id"), F.col(plain[text_column]).alias("text"))
    queries = asked.df.select(F.col(asked[item_column]).alias("item_id"), F.col(asked[query_column]).alias("text"))
    kinds = [rows.schema["doc_id"].dataType, queries.schema["item_id"].dataType]
    id_type, item_type = (k.simpleString() for k in kinds)
    arrow_id, arrow_item = (to_arrow_type(k) for k in kinds)
    found_type = f"query long, item_id {item_type}, doc_id {id_type}, score long"

    total = rows.mapInArrow(_measure, "documents long, terms long").agg(F.sum("documents").alias("d"), F.sum("terms").alias("t")).first()
    corpus = Corpus(total.d or 0, total.t or 0)
    found = spark.createDataFrame([], found_type)
    index_type = f"ids array<{id_type}>, " + ", ".join(f"{c} binary" for c in [*ARRAYS, "data"])
    for held in _blocks(queries, block):
        number = {t: i for i, t in enumerate(sorted({t for _, _, own in held for t in own}))}
        shards = written(rows.mapInArrow(_index(share(spark, number), corpus, arrow_id), index_type))
        counted = shards.mapInArrow(_df, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
        weight = dict(zip(counted["term"].to_pylist(), corpus.weights(counted["df"].to_numpy()).tolist(), strict=True))
        wanted = [(n, item, [(number[t], weight[number[t]]) for t in own if number[t] in weight]) for n, item, own in held]
        run = _search(share(spark, wanted), top, arrow_item, arrow_id)
        found = found.unionByName(shards.select("ids", *ARRAYS, "data").mapInArrow(run, found_type))

    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    # first among some tasks each, so that no one sorts what all tasks have found for a query
    part = Window.partitionBy("query", "part").orderBy(*order)
    some = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64))).withColumn("place", F.row_number().over(part)).where(F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op12_block_max_search(spark, sf_dir) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH held AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
corpus AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM held),
postings AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM held) GROUP BY doc_id, n, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), corpus
), asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term), corpus
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
