"""Collocations: phrases whose words stand together more often than their parts let one expect.

1. Words get hashes, and a prefix polynomial over them (Rabin-Karp, modulo 2**64) gives the fingerprint of every
   n-gram of a task's texts by two subtractions and a product in numpy. Equal n-grams of some megabytes are added up
   to (fingerprint, count, pointer to an occurrence) and shuffled by fingerprint, many in one row. Phrases are taken
   word by word longer: an n-gram can only be frequent if its two parts of n - 1 words are, so that a filter of the
   frequent shorter ones holds back the others. Fingerprints that collide are counted together, which can only let
   more through.
2. For frequent fingerprints only, pointers to their occurrences are followed to the text, in the task that holds it, so
   that no text is shuffled: all occurrences are compared word by word with the one pointed to, those that only share
   the fingerprint are parted, and the words are written out. Added up by these words, the counts are exact.
3. Scores, the search for longer candidates and the ranks are joins and windows over the frequent phrases.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import BitFilter, Plain, arrow_bytes, share, table
from touchline.llm.rolling import Roller, mix
from touchline.session import written

WORDS = 5
TIMES = 100
TOP = 2000
INSIDE = 100
NO_LANGUAGE = "und"
#: Bytes of text that are cut into words at once, and that are added up before rows are sent.
PART = 1 << 20
CHUNK = 8 << 20
#: Fingerprints that a task of the shuffle adds up, at most on average.
FINGERPRINTS = 2_000_000
#: Of a cleaned text: a blank ends a word, a full stop a piece too, and a comma the text. None is part of a word.
_BLANK, _STOP, _END = 32, 46, 44
_CLEAN = bytes(
    c + 32 if 65 <= c <= 90 else _BLANK if c == 9 else _STOP if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256)
)


def _slices(texts: list[bytes]) -> Iterator[bytes]:
    """Cleaned texts in parts of about ``PART`` bytes. A longer text is cut between words."""
    held, size = [], 0
    for text in texts:
        clean = text.translate(_CLEAN) + b","
        if size + len(clean) > PART and held:
            yield b"".join(held)
            held, size = [], 0
        while len(clean) > PART:
            cut = max(clean.rfind(b" ", 0, PART), clean.rfind(b".", 0, PART))
            if cut < 0:  # a word of that size
                cut = min(x for x in (clean.find(b" "), clean.find(b"."), len(clean) - 1) if x >= 0)
            yield clean[: cut + 1]
            clean = clean[cut + 1 :]
        held.append(clean)
        size += len(clean)
    if held:
        yield b"".join(held)


class Chunk:
    """The words of some texts of one language: their hashes, the piece each one stands in and, with ``exact``, a number
    that equal words alone share."""

    def __init__(self, roller: Roller, exact: bool) -> None:
        self.roller, self.exact = roller, exact
        self.number: dict[bytes, int] = defaultdict(lambda: len(self.number))
        self.found: list[tuple[np.ndarray, ...]] = []
        self.pieces = 0

    def add(self, texts: list[bytes]) -> None:
        for part in _slices(texts):
            buffer = np.frombuffer(part, np.uint8)
            ends = (buffer == _STOP) | (buffer == _END)
            inside = np.zeros(len(buffer) + 2, bool)
            inside[1:-1] = ~(ends | (buffer == _BLANK))
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            start, end = edges[::2], edges[1::2]
            hashes = self.roller.spans(self.roller.prefix(self.roller.bytes[buffer]), start, end)
            piece = np.cumsum(ends, dtype=np.int64)
            numbers = self._numbers(part, buffer, hashes, start, end) if self.exact else hashes[:0]
            self.found.append((hashes, piece[start] + self.pieces, numbers))
            self.pieces += int(piece[-1])

    def _numbers(self, part: bytes, buffer: np.ndarray, hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Words of one hash are compared byte by byte with the first of them, and only that one is looked up."""
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        size, other = end - start, first[which]
        same = bool((size == size[other]).all())
        if same and len(start):
            within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            same = bool((buffer[np.repeat(start, size) + within] == buffer[np.repeat(start[other], size) + within]).all())
        if not same:
            words = [part[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        words = [part[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))[which]

    def close(self) -> None:
        none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.hashes, self.piece, self.words = (np.concatenate(x) for x in zip(none, *self.found, strict=True))
        self.found = []
        self.spelled = list(self.number)

    def starts(self, n: int) -> np.ndarray:
        """Where ``n`` words of one piece begin."""
        if len(self.piece) < n:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[n - 1 :] == self.piece[: len(self.piece) - n + 1])

    def phrase(self, start: int, n: int) -> bytes:
        return b" ".join(self.spelled[i] for i in self.words[start : start + n].tolist())

    def told_apart(self, start: np.ndarray, fingerprint: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
        """(pointer, count) of the different phrases at ``start``: occurrences are compared word by word with the first
        of their fingerprint; those that differ are told apart by their words."""
        _, first, which, count = np.unique(fingerprint, return_index=True, return_inverse=True, return_counts=True)
        pointer = start[first]
        other = np.zeros(len(start), bool)
        for k in range(n):
            other |= self.words[start + k] != self.words[pointer[which] + k]
        if other.any():
            count = count - np.bincount(which[other], minlength=len(count))
            seen: dict[tuple, list[int]] = {}
            for s in start[other].tolist():
                seen.setdefault(tuple(self.words[s : s + n].tolist()), [s, 0])[1] += 1
            yield from ((s, c) for s, c in seen.values())
        yield from zip(pointer.tolist(), count.tolist(), strict=True)


def _chunks(batches: Iterator[pa.RecordBatch], roller: Roller, exact: bool = False) -> Iterator[list[tuple[str, Chunk]]]:
    """The languages of some megabytes of text."""
    held: dict[str, Chunk] = defaultdict(lambda: Chunk(roller, exact))
    size = 0

    def closed() -> list[tuple[str, Chunk]]:
        for chunk in held.values():
            chunk.close()
        return list(held.items())

    for batch in batches:
        waiting: dict[str, list[bytes]] = defaultdict(list)
        for language, text in zip(batch["lang"].to_pylist(), arrow_bytes(batch["text"]), strict=True):
            waiting[language].append(text)
            size += len(text)
            if size > CHUNK:
                for own, texts in waiting.items():
                    held[own].add(texts)
                yield closed()
                held.clear()
                waiting.clear()
                size = 0
        for own, texts in waiting.items():
            held[own].add(texts)
    if held:
        yield closed()


class Fingerprints:
    """Fingerprints of n-grams; with fewer ``bits`` more of them collide."""

    def __init__(self, bits: int = 64) -> None:
        self.roller, self.bits = Roller(), bits

    def of(self, chunk: Chunk, language: str) -> "Grams":
        seed = int.from_bytes(hashlib.blake2b(language.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return Grams(chunk, self.roller, self.roller.prefix(mix(chunk.hashes ^ np.uint64(seed))), 64 - self.bits)


class Grams:
    def __init__(self, chunk: Chunk, roller: Roller, sums: np.ndarray, shift: int) -> None:
        self.chunk, self.roller, self.sums, self.shift = chunk, roller, sums, np.uint64(shift)

    def at(self, start: np.ndarray, n: int) -> np.ndarray:
        found = self.roller.spans(self.sums, start, start + n)
        return mix(found >> self.shift) if self.shift else found

    def grown(self, filters: list[BitFilter]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, starts, fingerprints) for n = 1, 2, ... up to one word more than there are filters: of n-grams that the
        n-th filter may hold, and that consist of such shorter ones."""
        alive = None
        for n in range(1, len(filters) + 2):
            start = self.chunk.starts(n)
            if alive is not None:
                start = start[alive[start] & alive[start + 1]]
            found = self.at(start, n)
            if n <= len(filters):
                passed = filters[n - 1].may_hold(found.view(np.int64))
                start, found = start[passed], found[passed]
                alive = np.zeros(len(self.chunk.hashes) + 1, bool)
                alive[start] = True
            yield n, start, found


ENTRIES = "bucket int, fingerprints binary, counts binary"


def _entries(buckets: int, held: list, bits: int):
    """Fingerprints of the n-grams that are one word longer than the longest filter's, with their counts in a chunk: a
    row for each bucket of fingerprints."""
    edges = [(b << 64) // buckets for b in range(1, buckets)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, filters = Fingerprints(bits), [h() for h in held]
        inner = np.array(edges, np.uint64)
        for chunk in _chunks(batches, maker.roller):
            found = []
            for language, own in chunk:
                *_, (_, _, fingerprints) = maker.of(own, language).grown(filters)
                found.append(fingerprints)
            some, count = np.unique(np.concatenate(found), return_counts=True)
            count = count.astype(np.uint32)
            cut = [0, *np.searchsorted(some, inner).tolist(), len(some)]
            rows = [(b, some[x:y].tobytes(), count[x:y].tobytes()) for b, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]
            types = (pa.int32(), pa.binary(), pa.binary())
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "fingerprints", "counts"])

    return run


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(grams, kind="stable")
    grams = grams[order]
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[first], np.add.reduceat(counts[order], first)


def _frequent(times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = merged = 0
        for batch in batches:
            for grams, counts in zip(batch["fingerprints"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                parts.append((np.frombuffer(grams, np.uint64), np.frombuffer(counts, np.uint32).astype(np.int64)))
                size += len(parts[-1][0])
                if size > FINGERPRINTS + 2 * merged:
                    parts = [_added(parts)]
                    size = merged = len(parts[0][0])
        if parts:
            grams, counts = _added(parts)
            yield pa.RecordBatch.from_arrays([pa.array(grams[counts >= times].view(np.int64))], ["fingerprint"])

    return run


SPELLED = "bucket int, lang array<string>, phrase array<binary>, n array<int>, a array<long>"
_COLUMNS = {"lang": pa.string(), "phrase": pa.binary(), "n": pa.int32(), "a": pa.int64()}


def _spelled(buckets: int, held: list, bits: int):
    """The words of what the filters hold, with their counts in a chunk: of all that fall into a bucket of fingerprints
    one row. A fingerprint's pointer is followed in the chunk that it points to. With n = 0, ``a`` is the number of all
    words."""
    edges = [(b << 64) // buckets for b in range(1, buckets)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, filters = Fingerprints(bits), [h() for h in held]
        inner = np.array(edges, np.uint64)
        for chunk in _chunks(batches, maker.roller, exact=True):
            rows: dict[int, list[tuple]] = defaultdict(list)
            for language, own in chunk:
                rows[0].append((language, b"", 0, len(own.hashes)))
                for n, start, found in maker.of(own, language).grown(filters):
                    if n > len(filters):
                        break
                    order = np.argsort(found, kind="stable")
                    start, found = start[order], found[order]
                    cut = [0, *np.searchsorted(found, inner).tolist(), len(found)]
                    for bucket, (x, y) in enumerate(zip(cut, cut[1:])):
                        if y > x:
                            pointed = own.told_apart(start[x:y], found[x:y], n)
                            rows[bucket].extend((language, own.phrase(s, n), n, count) for s, count in pointed)
            for bucket, entries in rows.items():
                columns = [pa.array([c], pa.list_(t)) for c, t in zip(zip(*entries, strict=True), _COLUMNS.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *columns], ["bucket", *_COLUMNS])

    return run


def _exact(times: int):
    """Adds up what is spelled alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        size = merged = 0

        def added() -> pa.Table:
            keys = list(_COLUMNS)[:3]
            return pa.concat_tables(parts).group_by(keys).aggregate([("a", "sum")]).rename_columns([*keys, "a"]).select(list(_COLUMNS))

        for batch in batches:
            parts.append(pa.table([batch[c].flatten() for c in _COLUMNS], schema=pa.schema(list(_COLUMNS.items()))))
            size += len(parts[-1])
            if size > FINGERPRINTS // 4 + 2 * merged:
                parts = [added()]
                size = merged = len(parts[0])
        if parts:
            found = added()
            yield from found.filter((pc.field("a") >= times) | (pc.field("n") == 0)).to_batches(max_chunksize=100_000)

    return run


def frequent_phrases(texts: DataFrame, words: int = WORDS, times: int = TIMES, bits: int = 64) -> DataFrame:
    """(lang, phrase, n, a) of (lang, text): the phrases of up to ``words`` words that occur ``times`` times, with
    exact counts; under n = 0 the number of a language's words."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    buckets = 1 + size // (6 * FINGERPRINTS)
    held = []
    for _ in range(words):
        entries = texts.mapInArrow(_entries(buckets, held, bits), ENTRIES).repartition(buckets, "bucket")
        frequent = written(entries.select("fingerprints", "counts").mapInArrow(_frequent(times), "fingerprint long"))
        held.append(share(spark, BitFilter.of(frequent, "fingerprint", frequent.count())))
    spelled = texts.mapInArrow(_spelled(buckets, held, bits), SPELLED).repartition(buckets, "bucket")
    counted = spelled.drop("bucket").mapInArrow(_exact(times), "lang string, phrase binary, n int, a long")
    return written(counted.withColumn("phrase", F.col("phrase").cast("string")))


def collocations(
    docs: DataFrame,
    words: int = WORDS,
    times: int = TIMES,
    top: int = TOP,
    inside: int = INSIDE,
    text_column: str = "text",
    lang_column: str = "lang",
    bits: int = 64,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words ``[^\\x20\\x09]+``. A
    null text is empty, a null language ``und``. Of all n words of a language, a phrase of 2 to ``words`` words
    occurs ``a`` times inside pieces, overlaps included; it takes part if that is at least ``times``. Cut after its
    first k words into parts that occur l and r times, it scores ``floor(1000 a n / (l r))``; its lowest cut counts,
    and of equal ones the first. A phrase goes if a longer one that holds it occurs at least ``inside`` hundredths as
    often. The others are ranked by score and ``a``, descending, and the phrase's bytes. Repeated rows count each time;
    an empty table, or one without frequent phrases, gives an empty result; other columns play no part."""
    if words < 2:
        raise ValueError("a phrase has two words at least")
    plain = Plain(docs)
    texts = plain.df.select(
        F.coalesce(F.col(plain[lang_column]).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(plain[text_column]), F.lit("")).alias("text"),
    )
    counted = frequent_phrases(texts, words, times, bits)
    totals = counted.where("n = 0").select("lang", F.col("a").alias("all_words"))
    phrases = counted.where("n > 0")
    part = phrases.select("lang", "phrase", "a")
    candidates = phrases.where("n > 1").withColumn("words", F.split("phrase", " ", -1))

    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1))).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", F.lit(1), k), " ").alias("first"),
        F.array_join(F.slice("words", k + 1, F.col("n") - k), " ").alias("rest"),
    )
    lefts, rights = (part.withColumnsRenamed({"phrase": p, "a": c}) for p, c in (("first", "l"), ("rest", "r")))
    long = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "all_words")}
    # exact: a quotient of decimals, cut to a whole number; it is at most ten times n
    product = (F.lit(1000).cast("decimal(4,0)") * long["a"]).cast("decimal(23,0)") * long["all_words"].cast("decimal(15,0)")
    scored = (
        cuts.join(lefts, ["lang", "first"])
        .join(rights, ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("product", product)
        .withColumn("square", long["l"].cast("decimal(19,0)") * long["r"].cast("decimal(19,0)"))
        .withColumn("score", F.expr("product div square"))
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = scored.groupBy("lang", "phrase", "a", F.col("all_words").alias("n")).agg(lowest)

    # a longer phrase occurs no more often than one of a word less that it holds, so that these tell enough
    longer = candidates.where("n > 2").select("lang", F.col("a").alias("longer"), F.explode(
        F.array(F.array_join(F.slice("words", F.lit(1), F.col("n") - 1), " "), F.array_join(F.slice("words", F.lit(2), F.col("n") - 1), " "))
    ).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("longer") * 100 < F.col("a") * inside, F.lit(True))
    ).select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))

    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # first among parts of a language, so that no task sorts all of one
    parts = Window.partitionBy("lang", "part").orderBy(*order)
    some = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_fingerprints(spark, sf_dir) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), grams AS (
  SELECT lang, size, unnest([words[i : i + size - 1] FOR i IN range(1, len(words) - size + 2)]) AS gram
  FROM worded, (SELECT unnest(range(1, 6)) AS size) WHERE len(words) >= size
), total AS (SELECT lang, count(*) AS n FROM grams WHERE size = 1 GROUP BY lang),
frequent AS (
  SELECT lang, size, gram, array_to_string(gram, ' ') AS phrase, count(*) AS a FROM grams GROUP BY lang, size, gram HAVING count(*) >= 100
), cuts AS (
  SELECT lang, size, gram, phrase, a, unnest(range(1, size)) AS k FROM frequent WHERE size > 1
), scored AS (
  SELECT c.lang, c.size, c.gram, c.phrase, c.a, k, x.a AS l, y.a AS r, n,
         (1000 * CAST(c.a AS HUGEINT) * n) // (CAST(x.a AS HUGEINT) * y.a) AS score
  FROM cuts c
  JOIN frequent x ON x.lang = c.lang AND x.gram = c.gram[1:k]
  JOIN frequent y ON y.lang = c.lang AND y.gram = c.gram[k + 1:]
  JOIN total ON total.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), covered AS (
  SELECT DISTINCT s.lang, s.gram
  FROM (SELECT lang, size, a, gram, unnest(range(1, size + 1)) AS i FROM frequent WHERE size > 2) g,
       (SELECT unnest(range(2, 5)) AS short) w, frequent s
  WHERE short < g.size AND i + short - 1 <= g.size AND s.lang = g.lang AND s.gram = g.gram[i : i + short - 1]
    AND 100 * g.a >= 100 * s.a
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM best ANTI JOIN covered USING (lang, gram))
WHERE rank <= 2000
"""
