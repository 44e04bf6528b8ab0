"""A quality classifier: random-indexing vectors of words, pooled per document, and a two-layer network.

Each word has a fixed sparse random vector, drawn from its hash. One pass over all documents adds to a word's
context vector those of its neighbours, so that words in like company get like vectors. A document is the weighted
mean of its words' vectors, frequent words weighing less.

Every word has its own vector and count, however many there are. Both are Spark aggregates by the word's 64-bit hash.
The vectors of the most frequent words are broadcast. Those of the others go by a join to the documents that hold
them, some megabytes of text at a time. A word that stands once in the corpus has its whole context in its own
document. Vectors are added up as whole numbers, so that no order of rows changes a score. Input that is not read
from files should be written first.

A network of two layers, trained in numpy on a bounded sample of labelled documents, gives a probability, which a
temperature fitted on labelled documents apart from those calibrates.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import BitFilter, Plain, arrow_bytes, released, share, table, text_key
from touchline.llm.recurrence import HASHED, chunks
from touchline.llm.rolling import Roller, mix
from touchline.session import arrow_batches, written

#: Words whose vectors are broadcast, at most: 32 MB.
FREQUENT = 1 << 17
DIMENSIONS = 64
FEATURES = DIMENSIONS + 2
#: Entries of a word's random vector that are not 0.
ENTRIES = 4
#: Neighbours on either side that make a word's context.
REACH = 2
#: Steps of a vector's numbers when they are added up.
UNIT = float(1 << 24)
#: Words whose contexts a task adds up, on average.
WORDS = 30_000
#: Bytes of text that are counted together, and of those that ask for their words together.
CHUNK = 8 << 20
ASKING = 24 << 20
#: Words told to texts that a task gathers before it packs them.
TOLD = 400_000
#: Parts of the texts, by hash, that get their words one after the other, so that only a part's words are on disk.
TURNS = 3
#: Labelled documents for training and calibration, at most: those with the least hashes of their ids.
SAMPLE = 20_000
HIDDEN = 32
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _words(roller: Roller, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the words of all texts, and how many there are up to each text's end.

    A word is a run of lower-case letters (and of all letters but A-Z), of capitals, of digits or of signs."""
    found = [_words_at_once(roller, some) for _, some in chunks(texts, HASHED)]
    before = np.cumsum([0, *[len(hashes) for hashes, _ in found]])
    hashes = [np.zeros(0, np.uint64), *[hashes for hashes, _ in found]]
    ends = [np.zeros(0, np.int64), *[ends + n for (_, ends), n in zip(found, before, strict=False)]]
    return np.concatenate(hashes), np.concatenate(ends)


def _words_at_once(roller: Roller, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buffer = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = np.full(256, 4, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = 0
    kind[97:123] = kind[128:] = 1
    kind[65:91], kind[48:58] = 2, 3
    kinds = np.concatenate(([0], kind[buffer], [0]))
    edges = np.flatnonzero(kinds[1:] != kinds[:-1])
    start, end = edges[:-1], edges[1:]
    real = kinds[start + 1] > 0
    start, end = start[real], end[real]
    hashes = roller.spans(roller.prefix(roller.bytes[buffer]), start, end)
    ends = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]) - 1)
    return hashes, ends


def random_vectors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(dimensions, signs) of the entries of each word's random vector."""
    seeds = mix(words[:, None] + np.arange(1, ENTRIES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (seeds % np.uint64(DIMENSIONS)).astype(np.int64), np.where(seeds >> np.uint64(63), 1.0, -1.0)


def _contexts(some: np.ndarray, which: np.ndarray, wanted: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sums of the neighbours' random vectors for the ``wanted`` among the different words ``some`` of some texts;
    ``which`` is the number of each place's word."""
    dimension, sign = random_vectors(some)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    number = np.cumsum(wanted) - 1
    total = np.zeros(int(wanted.sum()) * DIMENSIONS)
    for apart in range(1, REACH + 1):
        same = text[apart:] == text[:-apart]
        a, b = which[:-apart][same], which[apart:][same]
        for word, near in ((a, b), (b, a)):
            these = wanted[word]
            word, near = number[word[these]], near[these]
            cells = (word[:, None] * DIMENSIONS + dimension[near]).ravel()
            total += np.bincount(cells, weights=sign[near].ravel(), minlength=len(total))
    return total.reshape(-1, DIMENSIONS).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roller = Roller()
    for batch in batches:
        for _, some_texts in chunks(arrow_bytes(batch["text"]), CHUNK):
            # hashed in parts, for each byte of a part becomes several numbers
            parts = [np.unique(_words(roller, texts)[0], return_counts=True) for _, texts in chunks(some_texts)]
            some, count = _added(parts)
            yield pa.RecordBatch.from_arrays([pa.array(some.view(np.int64)), pa.array(count)], ["word", "n"])


def _added(parts: list[tuple[np.ndarray, ...]], dtype: type = np.int64) -> list[np.ndarray]:
    """The different words of parts, in order, and what belongs to each one added up. A part has a word once."""
    words = np.unique(np.concatenate([p[0] for p in parts]))
    sums = [np.zeros((len(words), *x.shape[1:]), dtype) for x in parts[0][1:]]
    for own, *values in parts:
        at = np.searchsorted(words, own)
        for total, value in zip(sums, values, strict=True):
            total[at] += value
    return [words, *sums]


#: The types that a context's numbers are sent in: the smallest that holds all of them.
_KINDS = (np.int8, np.int16, np.int32)
PACKED = "bucket int, kind int, n int, words binary, counts binary, contexts binary"


def _kinds(total: np.ndarray) -> np.ndarray:
    most = np.abs(total).max(axis=1, initial=0)
    return (most > np.iinfo(np.int8).max).astype(np.int64) + (most > np.iinfo(np.int16).max)


def _context_rows(frequent, recurring, buckets: int):
    """Counts and contexts, many words to a row: of the frequent words once a task, of the other words that recur once
    for some texts. A bucket has the words of a range of hashes."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)

    def rows(words: np.ndarray, count: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        cut = np.searchsorted(words, edges)
        bucket = np.zeros(len(words) + 1, np.int64)
        np.add.at(bucket, cut, 1)
        bucket = np.cumsum(bucket[:-1])
        kind = _kinds(total)
        group = bucket * len(_KINDS) + kind
        order = np.argsort(group, kind="stable")
        at = np.flatnonzero(np.diff(group[order], prepend=-1))
        out = []
        for these in np.split(order, at[1:]) if len(at) else ():
            k = int(kind[these[0]])
            data = (words[these], count[these].astype(np.int64), total[these].astype(_KINDS[k]))
            out.append((int(bucket[these[0]]), k, len(these), *[pa.compress(x.tobytes(), "zstd", asbytes=True) for x in data]))
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "kind", "n", "words", "counts", "contexts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, often, known = Roller(), frequent(), recurring()
        counts, totals = np.zeros(len(often), np.int64), np.zeros((len(often), DIMENSIONS), np.int32)
        for batch in batches:
            for _, some_texts in chunks(arrow_bytes(batch["text"]), CHUNK // 2):
                parts = []
                for _, texts in chunks(some_texts):
                    words, ends = _words(roller, texts)
                    some, which, count = np.unique(words, return_inverse=True, return_counts=True)
                    at, is_often = _at(often, some)
                    wanted = is_often | known.may_hold(some)
                    total = _contexts(some, which, wanted, ends).astype(np.int32)
                    some, count, at, is_often = some[wanted], count[wanted], at[wanted], is_often[wanted]
                    counts[at[is_often]] += count[is_often]
                    totals[at[is_often]] += total[is_often]
                    parts.append((some[~is_often], count[~is_often], total[~is_often]))
                yield rows(*_added(parts, np.int32))
        for a in range(0, len(often), WORDS):
            seen = a + np.flatnonzero(counts[a : a + WORDS])
            yield rows(often[seen], counts[seen], totals[seen])

    return run


def _unzipped(data: bytes, n: int, dtype: type) -> np.ndarray:
    size = n * np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True), dtype)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, context) of the words of some buckets."""
    parts: list[tuple[np.ndarray, ...]] = []
    size = merged = 0
    for batch in batches:
        for kind, n, words, counts, contexts in zip(*(batch[c].to_pylist() for c in ("kind", "n", "words", "counts", "contexts")), strict=True):
            held = _unzipped(contexts, n * DIMENSIONS, _KINDS[kind]).reshape(-1, DIMENSIONS)
            parts.append((_unzipped(words, n, np.uint64), _unzipped(counts, n, np.int64), held))
            size += len(held)
            if size > 4 * WORDS + 2 * merged:
                parts = [tuple(_added(parts))]
                size = merged = len(parts[0][0])
    if parts:
        words, counts, contexts = _added(parts)
        for a in range(0, len(words), WORDS):
            b = a + WORDS
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[a:b].view(np.int64)), pa.array(counts[a:b]), pa.array(_packed(contexts[a:b]), pa.binary())], ["word", "n", "context"]
            )


def _packed(total: np.ndarray) -> list[bytes]:
    """Contexts in as few bytes as their numbers need."""
    kind, data = _kinds(total), np.empty(len(total), object)
    for k, dtype in enumerate(_KINDS):
        these = kind == k
        data[these] = [x.tobytes() for x in total[these].astype(dtype)]
    return data.tolist()


def _at(table: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word stands in a sorted table, and whether it does."""
    at = np.searchsorted(table, words)
    at[at == len(table)] = 0
    return at, (table[at] == words if len(table) else np.zeros(len(words), bool))


def _unpacked(data: list[bytes | None]) -> np.ndarray:
    """Contexts; of a word that has none, zeros."""
    out = np.zeros((len(data), DIMENSIONS), np.int64)
    sizes = np.array([len(x or b"") for x in data], np.int64)
    for kind in _KINDS:
        these = np.flatnonzero(sizes == DIMENSIONS * np.dtype(kind).itemsize)
        out[these] = np.frombuffer(b"".join(data[i] for i in these), kind).reshape(-1, DIMENSIONS)
    return out


def vectors_of(words: np.ndarray, count: np.ndarray, context: np.ndarray, all_words: int) -> np.ndarray:
    """The vectors of words: the direction of the context and the own random vector, times a weight that falls with
    the frequency. In whole steps of 1 / UNIT."""
    vectors = context / (np.sqrt((context.astype(np.float64) ** 2).sum(axis=1, keepdims=True)) + 1e-9)
    dimension, sign = random_vectors(words)
    np.add.at(vectors, (np.arange(len(words))[:, None], dimension), sign / np.sqrt(ENTRIES))
    weight = 1e-2 / (1e-2 + count / max(1, all_words))
    return np.rint(vectors * weight[:, None] * UNIT).astype(np.int64)


class WordVectors:
    """The vectors of all words of a corpus: a table of the frequent words and the number of all on executors, a
    filter of the other words that recur, and the counts and contexts of these in a DataFrame."""

    def __init__(self, texts: DataFrame) -> None:
        """Of the column ``text``."""
        spark = texts.sparkSession
        with arrow_batches(spark, CHUNK):
            counted = written(texts.mapInArrow(released(_counts), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
        # eight steps for each doubling of the count
        step = F.floor(F.log2("n") * 8).cast("int")
        steps = sorted(counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect(), reverse=True)
        self.all_words, held, least, others = sum(r.n for r in steps), 0, 1 << 30, 0
        for r in steps:
            if least > r.step >= 8 and held + r.words <= FREQUENT and not others:
                held, least = held + r.words, r.step
            elif r.step >= 8:
                others += r.words
        words = counted.where(step >= least).select("word").toArrow()["word"].to_numpy().view(np.uint64)
        frequent = share(spark, np.sort(words))
        self.recurring = share(spark, BitFilter.of(counted.where((step < least) & (F.col("n") > 1)), "word", others))
        buckets = 1 + (held + others) // WORDS
        rows = texts.mapInArrow(released(_context_rows(frequent, self.recurring, buckets)), PACKED).repartition(buckets, "bucket")
        with arrow_batches(spark, CHUNK):
            contexts = written(rows.mapInArrow(released(_summed), "word long, n long, context binary"))
        got = contexts.where(step >= least).toArrow()
        word, n = got["word"].to_numpy().view(np.uint64), got["n"].to_numpy()
        order = np.argsort(word)
        vectors = vectors_of(word, n, _unpacked(got["context"].to_pylist()), self.all_words)[order]
        self.frequent = share(spark, (word[order], vectors.astype(np.int32)))
        self.others = contexts.where(step < least)

    def features(self, docs: DataFrame, text: str, keep: list[str], turns: int = TURNS) -> DataFrame:
        """The columns ``keep`` of each row of ``docs`` and its ``features``, written."""
        turn = F.pmod(F.xxhash64(text), F.lit(turns))
        with arrow_batches(docs.sparkSession, ASKING):
            return reduce(DataFrame.unionByName, [written(self._features(docs.where(turn == i), text, keep)) for i in range(turns)])

    def _features(self, docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
        kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
        rows = docs.withColumn("row", F.monotonically_increasing_id())
        asked = rows.mapInArrow(
            released(_asked(self.frequent, self.recurring, self.all_words, text, keep)),
            f"chunk long, word long, text int, places array<int>, sums binary, words long{', ' if keep else ''}{kinds}",
        )
        known = asked.join(self.others, "word", "left")
        told = known.mapInArrow(released(_told(keep)), f"chunk long, text int, sums binary, words long, told binary{', ' if keep else ''}{kinds}")
        return told.groupBy("chunk").applyInArrow(_pooled(self.all_words, keep), f"{kinds}{', ' if keep else ''}features binary")


def _sum_up(vectors: np.ndarray, which: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Add up the rows ``which`` of ``vectors`` that belong to each of ``n`` texts; ``text`` ascends. One dimension
    after the other, for numpy adds up parts of a row of numbers far faster than parts of a table."""
    out = np.zeros((n, DIMENSIONS), np.int64)
    if len(text):
        first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
        for k in range(DIMENSIONS):
            out[text[first], k] = np.add.reduceat(vectors[:, k].astype(np.int64)[which], first)
    return out


def _narrow(sums: np.ndarray) -> list[bytes]:
    """Each row of whole numbers in as many bytes a number as all rows need."""
    most = int(np.abs(sums).max(initial=0))
    size = next(b for b in range(1, 9) if b == 8 or most < 1 << (8 * b - 1))
    low = np.ascontiguousarray(sums.astype("<i8").view(np.uint8).reshape(len(sums), DIMENSIONS, 8)[:, :, :size])
    return [x.tobytes() for x in low]


def _wide(rows: list[bytes]) -> np.ndarray:
    """The rows that ``_narrow`` made, each batch of them in its own width."""
    out = np.zeros((len(rows), DIMENSIONS), np.int64)
    sizes = np.array([len(x) // DIMENSIONS for x in rows], np.int64)
    for size in np.unique(sizes).tolist():
        these = np.flatnonzero(sizes == size)
        full = np.zeros((len(these), DIMENSIONS, 8), np.uint8)
        full[:, :, 8 - size :] = np.frombuffer(b"".join(rows[i] for i in these), np.uint8).reshape(-1, DIMENSIONS, size)
        out[these] = full.reshape(len(these), -1).view("<i8") >> (8 * (8 - size))
    return out


#: What a text's chunk is told of a word.
_ANSWER = ["word", "n", "places", "context"]


def _told(keep: list[str]):
    """Rows of texts as they are; of the words' rows those that a task has for a chunk in one, compressed."""

    def packs(rows: list[pa.RecordBatch], kinds: list[pa.DataType]) -> pa.RecordBatch:
        rare = pa.Table.from_batches(rows)
        # contexts of words that are as frequent have numbers of like size, and compress better together
        rare = rare.take(pa.compute.sort_indices(rare, [("chunk", "ascending"), ("n", "ascending")])).combine_chunks()
        chunk = rare["chunk"].to_numpy()
        first = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
        out, answers = [], rare.select(_ANSWER)
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(chunk)], strict=True):
            held = pa.BufferOutputStream()
            with pa.ipc.new_stream(held, answers.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(answers.slice(a, b - a))
            out.append(held.getvalue().to_pybytes())
        n = len(out)
        none = [pa.nulls(n, t) for t in (pa.int32(), pa.binary(), pa.int64())]
        columns = [pa.array(chunk[first]), *none, pa.array(out, pa.binary()), *[pa.nulls(n, t) for t in kinds]]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "text", "sums", "words", "told", *keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, kinds = [], 0, []
        for batch in batches:
            kinds = [batch[c].type for c in keep]
            is_text = pa.compute.is_valid(batch["text"])
            texts = batch.filter(is_text)
            if texts.num_rows:
                columns = [*[texts[c] for c in ("chunk", "text", "sums", "words")], pa.nulls(texts.num_rows, pa.binary()), *[texts[c] for c in keep]]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "text", "sums", "words", "told", *keep])
            rare = batch.filter(pa.compute.invert(is_text)).select(["chunk", *_ANSWER])
            if rare.num_rows:
                rows.append(rare)
                held += rare.num_rows
            if held >= TOLD:
                yield packs(rows, kinds)
                rows, held = [], 0
        if rows:
            yield packs(rows, kinds)

    return run


def _asked(frequent, recurring, all_words: int, text_column: str, keep: list[str]):
    """For each text a row with the sum over its frequent words and those that stand nowhere else; for each other
    word of some texts a row with the texts where it occurs, one for each occurrence. The first kind asks for a word
    that is none, another one in each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, (often, table), known = Roller(), frequent(), recurring()
        for batch in batches:
            row = batch["row"].to_numpy()
            for begin, some_texts in chunks(arrow_bytes(batch[text_column]), ASKING):
                n = len(some_texts)
                sums, words = np.zeros((n, DIMENSIONS), np.int64), np.zeros(n, np.int64)
                rare, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
                for start, texts in chunks(some_texts):
                    hashes, ends = _words(roller, texts)
                    different, which, count = np.unique(hashes, return_inverse=True, return_counts=True)
                    at, is_often = _at(often, different)
                    ask = ~is_often & known.may_hold(different)
                    alone = ~is_often & ~ask
                    vectors = np.zeros((len(different), DIMENSIONS), np.int32)
                    vectors[is_often] = table[at[is_often]]
                    vectors[alone] = vectors_of(different[alone], count[alone], _contexts(different, which, alone, ends), all_words)
                    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                    sums[start : start + len(texts)] = _sum_up(vectors, which, text, len(texts))
                    words[start : start + len(texts)] = np.diff(ends, prepend=0)
                    asks = ask[which]
                    rare.append(hashes[asks])
                    held.append((text[asks] + start).astype(np.int32))
                word, which = np.unique(np.concatenate(rare), return_inverse=True)
                places = np.concatenate(held)[np.argsort(which, kind="stable")]
                ends = np.concatenate(([0], np.cumsum(np.bincount(which, minlength=len(word)))))
                own = mix(row[begin : begin + n].astype(np.uint64) + np.uint64(0x0DD))
                k, chunk = len(word), row[begin]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n + k, chunk)),
                        pa.array(np.concatenate((own, word)).view(np.int64)),
                        pa.concat_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.nulls(k, pa.int32())]),
                        pa.concat_arrays([pa.nulls(n, pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(places))]),
                        pa.array([*_narrow(sums), *[None] * k], pa.binary()),
                        pa.concat_arrays([pa.array(words), pa.nulls(k, pa.int64())]),
                        *[pa.concat_arrays([batch[c].slice(begin, n), pa.nulls(k, batch[c].type)]) for c in keep],
                    ],
                    ["chunk", "word", "text", "places", "sums", "words", *keep],
                )

    return run


def _opened(packs: list[bytes], most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """What packs hold, about ``most`` rows at a time; no more packs are open than these rows need."""
    held, n = [], 0
    for i, pack in enumerate(packs):
        held.append(pa.ipc.open_stream(pack).read_all())
        n += held[-1].num_rows
        if n >= most or i + 1 == len(packs):
            yield from pa.concat_tables(held).combine_chunks().to_batches(max_chunksize=most)
            held, n = [], 0


def _pooled(all_words: int, keep: list[str]):
    """Of each text of a chunk: the mean vector, its length (which tells how alike the words are), and the logarithm
    of the number of words; zeros for a text without words."""

    def run(part: pa.Table) -> pa.Table:
        is_text = pa.compute.is_valid(part["text"])
        texts, packs = part.filter(is_text), part.filter(pa.compute.invert(is_text))["told"].to_pylist()
        text, words = texts["text"].to_numpy(), texts["words"].to_numpy()
        sums = np.zeros((len(text), DIMENSIONS), np.int64)
        sums[text] = _wide(texts["sums"].to_pylist())
        for batch in _opened(packs):
            n = batch["n"].fill_null(1).to_numpy(zero_copy_only=False)
            vectors = vectors_of(batch["word"].to_numpy().view(np.uint64), n, _unpacked(batch["context"].to_pylist()), all_words)
            places = batch["places"].flatten().to_numpy()
            which = np.repeat(np.arange(len(vectors)), batch["places"].value_lengths().to_numpy())
            order = np.argsort(places, kind="stable")
            for some in np.array_split(order, 1 + len(order) // 200_000):
                sums += _sum_up(vectors, which[some], places[some], len(sums))
        out = np.zeros((len(text), FEATURES), np.float32)
        out[:, :DIMENSIONS] = sums[text] / (UNIT * np.maximum(words, 1))[:, None]
        out[:, DIMENSIONS] = np.linalg.norm(out[:, :DIMENSIONS], axis=1)
        out[:, DIMENSIONS + 1] = np.log1p(words)
        pa.default_memory_pool().release_unused()
        return pa.table([*[texts[c] for c in keep], pa.array([x.tobytes() for x in out], pa.binary())], names=[*keep, "features"])

    return run


class Network:
    """Two layers, tanh and logistic, by Adam on the log loss; then a temperature on rows apart from those."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, hidden: int = HIDDEN, rounds: int = 60) -> None:
        rng = np.random.default_rng(7)
        self.shift, self.scale = features.mean(0), features.std(0) + 1e-6
        x, y = (features - self.shift) / self.scale, labels.astype(np.float64)
        apart = np.arange(len(y)) % 5 == 0
        self.weights = [
            rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)),
            np.zeros(hidden),
            rng.normal(0, 1 / np.sqrt(hidden), hidden),
            np.zeros(1),
        ]
        self.temperature = 1.0
        self._train(x[~apart], y[~apart], rounds, rng)
        if apart.any():
            raw = self._raw(x[apart])
            choices = np.exp(np.linspace(-2, 3, 101))
            # half a row of each kind, so that no finite sample asks for certainty
            losses = [np.logaddexp(0, np.where(y[apart] > 0, -raw, raw) / t).sum() + 0.5 * np.logaddexp(0, np.abs(raw).max() / t) for t in choices]
            self.temperature = float(choices[int(np.argmin(losses))])

    def _raw(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(x @ a + b) @ c + d[0]

    def _train(self, x: np.ndarray, y: np.ndarray, rounds: int, rng) -> None:
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step, decay = 0, 1e-4
        for _ in range(rounds):
            for batch in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
                a, b, c, d = self.weights
                mid = np.tanh(x[batch] @ a + b)
                error = (1 / (1 + np.exp(-np.clip(mid @ c + d[0], -40, 40))) - y[batch]) / len(batch)
                back = np.outer(error, c) * (1 - mid**2)
                slopes = [x[batch].T @ back + decay * a, back.sum(0), mid.T @ error + decay * c, np.array([error.sum()])]
                step += 1
                for i, slope in enumerate(slopes):
                    first[i] = 0.9 * first[i] + 0.1 * slope
                    second[i] = 0.999 * second[i] + 0.001 * slope**2
                    rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.weights[i] = self.weights[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)

    def __call__(self, features: np.ndarray) -> np.ndarray:
        raw = self._raw((features - self.shift) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


class Classifier:
    """Word vectors of a corpus, a network, and the features of the corpus."""

    def __init__(self, plain: Plain, vectors: WordVectors, rows: DataFrame, network: Network | None) -> None:
        self.plain, self.vectors, self.rows = plain, vectors, rows
        self.fitted, self.network = network is not None, share(rows.sparkSession, network)

    def scored(self) -> DataFrame:
        """The corpus's kept columns under the names of ``plain``, with a column ``score``. Without any labelled row
        all scores are 0.5."""
        network, kept = self.network, [c for c in self.rows.columns if c != "features"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            probability = network()
            for batch in batches:
                features = np.frombuffer(b"".join(batch["features"].to_pylist()), np.float32).reshape(-1, FEATURES)
                score = np.full(len(features), 0.5) if probability is None else probability(features)
                yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(score)], [*kept, "score"])

        return self.rows.mapInArrow(run, self.rows.select(*kept).withColumn("score", F.lit(0.0)).schema)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    keep: list[str] | None = None,
) -> Classifier:
    """Word vectors and features from all of ``docs``, the network from at most ``sample`` labelled rows that are not
    held out. Rows of ``labels`` without id or label are left out. ``keep`` has the columns that go with the features,
    the id among them; all by default."""
    plain, marks = Plain(docs), Plain(labels)
    vectors = WordVectors(plain.df.select(F.col(plain[text_column]).alias("text")))
    kept = plain.columns if keep is None else [plain[c] for c in keep]
    rows = vectors.features(plain.df, plain[text_column], kept)
    known = (
        marks.df.select(F.col(marks[id_column]).alias("doc_id"), F.col(marks[label_column]).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )
    # at most ``sample`` rows are broadcast
    got = rows.select(F.col(plain[id_column]).alias("doc_id"), "features").join(F.broadcast(known), "doc_id")
    # rows that repeat an id count once, so that no more than ``sample`` come to the driver
    got = got.groupBy("doc_id", "label").agg(F.min("features").alias("features")).collect()
    network = None
    if got:
        got.sort(key=lambda r: (r.doc_id, r.label, r.features))
        order = np.random.default_rng(1).permutation(len(got))
        features = np.frombuffer(b"".join([got[i].features for i in order]), np.float32).reshape(len(got), -1)
        network = Network(features.astype(np.float64), np.array([got[i].label for i in order]))
    return Classifier(plain, vectors, rows, network)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted (1 from ``threshold`` on).

    A null or empty text has no words and gets the score of a zero vector; a null id is not held out; rows that
    repeat get equal scores; other columns play no part."""
    model = fit(docs, labels, id_column=id_column, text_column=text_column, keep=[id_column])
    doc_id = F.col(model.plain[id_column])
    return model.scored().select(
        doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def good_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text", **columns: str
) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns. Without any labelled row to
    learn from it rejects none.

    A score depends on the text alone. So texts are scored by their hashes, and rows leave whose text is rejected; no
    text goes with the words."""
    plain = Plain(docs)
    keys = [f"{id_column}_{text_column}_{i}" for i in range(2)]
    hashes = [h.alias(k) for h, k in zip(text_key(F.col(plain[text_column])), keys, strict=True)]
    rows = plain.df.select(F.col(plain[id_column]).alias(id_column), F.col(plain[text_column]).alias(text_column), *hashes)
    model = fit(rows, labels, id_column=id_column, text_column=text_column, keep=[id_column, *keys], **columns)
    if not model.fitted:
        return docs
    rejected = model.scored().where(F.col("score") < threshold).select(*[F.col(model.plain[k]).alias(k) for k in keys]).distinct()
    return plain.restore(plain.df.select("*", *hashes).join(written(rejected), keys, "left_anti"))


def op3_quality_classifier(spark, sf_dir) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
