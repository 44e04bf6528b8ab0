"""Cross-entropy difference of documents under two bigram models.

The target model is learnt from documents labelled as good, the background model from all others; its counts are
scaled to the words of the target, so that the models are alike in size. Both share one vocabulary: the words that
occur often enough in the two together; all others are one unknown word. A word's loss is interpolated from its bigram
and its unigram, and a document's score is the mean difference of the losses, target less background: below zero, it
reads like the target.

The counts are shuffled many to a row: keys in order, by the difference to the one before, and byte by byte, so that
equal bytes lie together; a bucket has a range of keys and a bounded number of them. Documents ask for the counts of
their own n-grams some megabytes of text at a time. Bounded filters let only those ask that a model may hold. The
answers meet the texts of their chunk again, which knows the order that it asked in, and are added up there. This reads
the input more than once: input that does not come the same way each time (a shuffle without an order, say) must be
written first, and stops the job if an answer does not fit its chunk.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import BitFilter, Plain, arrow_bytes, share, table
from touchline.llm.recurrence import chunks
from touchline.llm.rolling import Roller, mix
from touchline.session import written

#: Times that a word, or a bigram, occurs in both training parts together to be in the models.
LEAST_WORD, LEAST_BIGRAM = 3, 2
#: The bigram's part in the interpolation.
WEIGHT = 0.6
#: The word before a document's first.
BEGIN = np.uint64(0x0BEB1)
#: Bytes of text that are counted, or ask for their n-grams, together, and those hashed at once.
CHUNK, PART = 8 << 20, 1 << 20
#: Bytes of ids of good documents that are shared; more are joined.
SHARED = 16 << 20
#: N-grams of the corpus in a bucket, on average, and those that are added up at once.
BUCKET = 1 << 20
#: Tables of counts.
WORD, PAIR = 0, 1

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _words_of(roller: Roller, buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of all words, hashed in parts that end at a space, for each byte becomes several numbers."""
    found, begin = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
    while begin < len(buffer):
        space = _SPACE.search(buffer, begin + PART)
        end = space.start() if space else len(buffer)
        words, start, _ = roller.words(np.frombuffer(buffer, np.uint8, end - begin, begin))
        found.append((words, start + begin))
        begin = end
    words, start = zip(*found, strict=True)
    return np.concatenate(words), np.concatenate(start)


def _pairs(roller: Roller, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word before, word) for each word of all texts."""
    words, start = _words_of(roller, b"\n".join(texts))
    until = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]) - 1)
    text = np.searchsorted(until, np.arange(len(words)), side="right")
    before = np.concatenate(([BEGIN], words)).astype(np.uint64)[: len(words)]
    first = np.concatenate(([0], until[:-1]))
    before[first[first < until]] = BEGIN
    return text, before, words


def _bigram(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(3) + word)


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word before, word, whether of the target part), some texts at a time."""
    roller = Roller()
    for batch in batches:
        side = batch["target"].to_numpy(zero_copy_only=False)
        for begin, texts in chunks(arrow_bytes(batch["text"]), CHUNK):
            text, before, word = _pairs(roller, texts)
            yield before, word, side[begin + text].astype(bool)


def _sums(which: np.ndarray, n: int, target: np.ndarray) -> list[np.ndarray]:
    """For each of ``n`` things its occurrences in the target and in the background."""
    t, all_ = np.bincount(which[target], minlength=n), np.bincount(which, minlength=n)
    return [t, all_ - t]


def _packed_keys(keys: np.ndarray) -> bytes:
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _keys(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _packed_counts(counts: np.ndarray) -> bytes:
    """In the fewest bytes that hold all."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _counts(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _cuts(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The buckets of sorted keys: ranges of their upper halves."""
    bucket = (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(first.tolist(), np.append(first[1:], len(keys)).tolist()[: len(first)], strict=True):
        yield int(bucket[a]), slice(a, b)


#: Keys of a bucket with what is counted of each; the sums cover keys that have been left out, too.
COUNTED = "bucket long, n long, keys binary, t binary, b binary, all_t binary, all_b binary, sum_t long, sum_b long"


def _rows(keys: np.ndarray, counts: list[np.ndarray], buckets: int, keep: np.ndarray | None = None) -> pa.RecordBatch:
    rows = []
    for bucket, these in _cuts(keys, buckets):
        sums = [int(c[these].sum()) for c in counts[:2]]
        kept = slice(None) if keep is None else keep[these]
        own = keys[these][kept]
        packed = [_packed_counts(c[these][kept]) for c in counts]
        rows.append((bucket, len(own), _packed_keys(own), *packed, *[None] * (4 - len(packed)), *sums))
    types = [pa.int64(), pa.int64(), *[pa.binary()] * 5, pa.int64(), pa.int64()]
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in COUNTED.split(", ")])


def _words(buckets: int):
    """How often each word stands in the training parts, and how often before another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for before, word, target in _training(batches):
            some, which = np.unique(np.concatenate((word, before)), return_inverse=True)
            own, as_before = (_sums(w, len(some), target) for w in np.split(which, 2))
            yield _rows(some, [*own, *as_before], buckets)

    return run


def _bigrams(words, buckets: int):
    """How often each bigram that may end in a known word stands in the training parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words()
        for before, word, target in _training(batches):
            may = known.may_hold(word)
            some, which = np.unique(_bigram(before[may], word[may]), return_inverse=True)
            yield _rows(some, _sums(which, len(some), target[may]), buckets)

    return run


def _unpacked(batch: pa.RecordBatch | pa.Table, columns: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
    for n, keys, *counts in zip(*(batch[c].to_pylist() for c in ("n", "keys", *columns)), strict=True):
        yield _keys(keys), *[_counts(c, n) for c in counts]


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Keys in order, with their counts added up."""
    keys, *counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[: len(keys)]
    return keys[first], *[np.add.reduceat(c[order], first) if len(first) else c for c in counts]


def _added(columns: list[str], buckets: int, keep):
    """The keys of some buckets that ``keep`` chooses by their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        size = merged = 0
        for batch in batches:
            for part in _unpacked(batch, columns):
                parts.append(part)
                size += len(part[0])
                if size > BUCKET + 2 * merged:
                    parts = [_merged(parts)]
                    size = merged = len(parts[0][0])
        if parts:
            keys, *counts = _merged(parts)
            yield _rows(keys, counts, buckets, keep(*counts))

    return run


def _often_words(t: np.ndarray, b: np.ndarray, all_t: np.ndarray, all_b: np.ndarray) -> np.ndarray:
    """Known words, and those that a bigram of a model may start with."""
    return (t + b >= LEAST_WORD) | (all_t + all_b >= LEAST_BIGRAM)


def _often_bigrams(t: np.ndarray, b: np.ndarray) -> np.ndarray:
    return t + b >= LEAST_BIGRAM


def _exploded(least: int):
    """The keys that were counted so often, one to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, t, b in _unpacked(batch, ["t", "b"]):
                yield pa.RecordBatch.from_arrays([pa.array(keys[t + b >= least].view(np.int64))], ["key"])

    return run


def _known(least: int):
    """(words, t, b) of the known words, summed up for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, t, b in _unpacked(batch, ["t", "b"]):
                often = t + b >= least
                sums = [int(often.sum()), int(t[often].sum()), int(b[often].sum())]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in sums], ["words", "t", "b"])

    return run


class Wanted:
    """What a chunk of texts has to know: its words and bigrams, in order, that a model may hold."""

    def __init__(self, roller: Roller, texts: list[bytes], bigrams: BitFilter, words: BitFilter) -> None:
        self.text, self.before, self.word = _pairs(roller, texts)
        pair = _bigram(self.before, self.word)
        self.known = words.may_hold(self.word)
        self.may = self.known & bigrams.may_hold(pair)
        self.pairs, self.pair = np.unique(pair[self.may], return_inverse=True)
        self.words = np.unique(np.concatenate((self.word[self.known], self.before[self.may])))


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[bytes]]]:
    """(rows of a chunk, its number, its texts)."""
    for batch in batches:
        for begin, texts in chunks(arrow_bytes(batch["text"]), CHUNK):
            rows = batch.slice(begin, len(texts))
            yield rows, rows["row"][0].as_py(), texts


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, chunk, _ in _chunked(batches):
        number = pa.array(np.arange(len(rows), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), chunk)), number, rows["doc_id"], rows["text"]], ["chunk", "number", "doc_id", "text"])


def _asked(bigrams, words, buckets: int):
    """(chunk, kind, bucket, n, keys): the words and bigrams that a chunk wants to know of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, pairs, known = Roller(), bigrams(), words()
        for _, chunk, texts in _chunked(batches):
            wanted = Wanted(roller, texts, pairs, known)
            rows = [
                (chunk, kind, bucket, these.stop - these.start, _packed_keys(keys[these]))
                for kind, keys in ((WORD, wanted.words), (PAIR, wanted.pairs))
                for bucket, these in _cuts(keys, buckets)
            ]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "kind", "bucket", "n", "keys"])

    return run


COUNTS = ["t", "b", "all_t", "all_b"]
ANSWER = "chunk long, kind int, bucket long, n long, t binary, b binary, all_t binary, all_b binary"


def _answers(asked: pa.Table, model: pa.Table) -> pa.Table:
    """The counts of what was asked of a bucket, none for what is not in it."""
    rows = []
    for chunk, kind, bucket, n, data in zip(*(asked[c].to_pylist() for c in ("chunk", "kind", "bucket", "n", "keys")), strict=True):
        columns = COUNTS if kind == WORD else COUNTS[:2]
        if not rows:
            held = list(_unpacked(model, columns))
            keys, *counts = held[0] if held else [np.zeros(0, np.int64)] * (1 + len(columns))
        wanted = _keys(data)
        at = np.searchsorted(keys, wanted) if len(keys) else np.zeros(n, np.int64)
        at[at == len(keys)] = 0
        found = keys[at] == wanted if len(keys) else np.zeros(n, bool)
        packed = [_packed_counts(np.where(found, c[at], 0) if len(keys) else np.zeros(n, np.int64)) for c in counts]
        rows.append((chunk, kind, bucket, n, *packed, *[None] * (4 - len(packed))))
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
    return pa.table(columns, names=[c.split()[0] for c in ANSWER.split(", ")])


def _told(bigrams, words, least: int, totals: tuple[int, int, int], scale: float, unknown: float):
    """The scores of a chunk's texts. Values are added up in the order of the words, so that equal texts score alike."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        n_t, n_b, size = totals
        texts, answers = texts.sort_by("number"), answers.sort_by("bucket")
        held = arrow_bytes(texts["text"])
        wanted = Wanted(Roller(), held, bigrams(), words())

        def counts(kind: int, keys: np.ndarray, columns: list[str]) -> list[np.ndarray]:
            own = answers.filter(pa.array(answers["kind"].to_numpy() == kind))
            n = own["n"].to_pylist()
            if sum(n) != len(keys):
                raise ValueError("texts came in another order when they were read again; write them first")
            none = [np.zeros(0, np.int64)]
            return [np.concatenate(none + [_counts(x, m) for x, m in zip(own[c].to_pylist(), n, strict=True)]) for c in columns]

        t, b, all_t, all_b = counts(WORD, wanted.words, COUNTS)
        p_t, p_b = (t + 1) / (n_t + size + 1), (b * scale + 1) / (n_b * scale + size + 1)
        is_word = t + b >= least
        of_word = np.where(is_word, np.log(p_b) - np.log(p_t), unknown)
        value = np.full(len(wanted.word), unknown)
        value[wanted.known] = of_word[np.searchsorted(wanted.words, wanted.word[wanted.known])]
        t, b = (x[wanted.pair] for x in counts(PAIR, wanted.pairs, COUNTS[:2]))
        word, before = (np.searchsorted(wanted.words, x[wanted.may]) for x in (wanted.word, wanted.before))
        mixed = [
            WEIGHT * np.where(all_ > 0, n / np.maximum(all_, 1), 0.0) + (1 - WEIGHT) * p[word]
            for n, all_, p in ((t, all_t[before], p_t), (b, all_b[before], p_b))
        ]
        of_pair = np.log(mixed[1]) - np.log(mixed[0])
        value[wanted.may] = np.where((t + b >= LEAST_BIGRAM) & is_word[word], of_pair, value[wanted.may])
        n_words = np.bincount(wanted.text, minlength=len(held))
        score = np.bincount(wanted.text, weights=value, minlength=len(held)) / np.maximum(n_words, 1)
        return pa.table([texts["doc_id"], pa.array(n_words), pa.array(score, mask=n_words == 0)], names=["doc_id", "n_words", "score"])

    return run


def _sides(rows: DataFrame, good: DataFrame) -> DataFrame:
    """(text, target): whether a row's id is good. So that texts stay where they are, the good ids go to them while
    these are few by size; otherwise both meet by id."""
    n, size = good.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col("good").cast("string")))).first()
    if 16 * n + (size or 0) <= SHARED:
        good = F.broadcast(good)
    return rows.join(good, F.col("doc_id") == F.col("good"), "left").select("text", F.col("good").isNotNull().alias("target"))


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, score (target loss less background loss, per word).

    A null, empty or blank text has no words and a null score; rows that repeat get equal scores; rows of
    ``labels`` without id are left out. Without any labelled good row both models are alike and scores are 0.

    Every row that is not good counts in the background, as often as it is there, and the counts are scaled to as many
    words as the target has."""
    spark = docs.sparkSession
    plain, marks = Plain(docs), Plain(labels)
    good = marks.df.where(F.col(marks[label_column]) == 1).select(F.col(marks[id_column]).alias("good")).distinct()
    rows = plain.df.select(F.col(plain[id_column]).alias("doc_id"), F.coalesce(F.col(plain[text_column]), F.lit("")).alias("text"))
    training = _sides(rows, good)

    # no bucket has more words than this leaves it, but for those that copies of one word fill: one for each chunk
    buckets = 1 + (training.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (4 * BUCKET)

    def counted(run, columns, keep):
        rows = training.mapInArrow(run, COUNTED).repartition(buckets, "bucket")
        return written(rows.mapInArrow(_added(columns, buckets, keep), COUNTED))

    all_words = counted(_words(buckets), COUNTS, _often_words)
    n_t, n_b = (x or 0 for x in all_words.agg(F.sum("sum_t"), F.sum("sum_b")).first())
    # a background word counts as so many; without a word in the target there is no model to tell apart
    scale = n_t / max(1, n_b)
    least = LEAST_WORD if n_t else 1 << 62
    sums = all_words.mapInArrow(_known(least), "words long, t long, b long")
    size, k_t, k_b = (x or 0 for x in sums.agg(F.sum("words"), F.sum("t"), F.sum("b")).first())
    unknown = float(np.log(((n_b - k_b) * scale + 1) / (n_b * scale + size + 1)) - np.log((n_t - k_t + 1) / (n_t + size + 1)))
    known = share(spark, BitFilter.of(all_words.mapInArrow(_exploded(least), "key long"), "key", size))
    pairs = counted(_bigrams(known, buckets), COUNTS[:2], _often_bigrams)
    n_pairs = pairs.agg(F.sum("n")).first()[0] or 0
    held = share(spark, BitFilter.of(pairs.mapInArrow(_exploded(LEAST_BIGRAM), "key long"), "key", n_pairs))

    id_type = rows.schema["doc_id"].dataType.simpleString()
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    asked = numbered.mapInArrow(_asked(held, known, buckets), "chunk long, kind int, bucket long, n long, keys binary")
    model = all_words.withColumn("kind", F.lit(WORD)).unionByName(pairs.withColumn("kind", F.lit(PAIR)))
    answers = asked.groupBy("kind", "bucket").cogroup(model.groupBy("kind", "bucket")).applyInArrow(_answers, ANSWER)
    texts = numbered.mapInArrow(_texts, f"chunk long, number int, doc_id {id_type}, text string")
    tell = _told(held, known, least, (n_t, n_b, size), scale, unknown)
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(tell, f"doc_id {id_type}, n_words long, score double")


def op2_cross_entropy_difference(spark, sf_dir) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
