"""Benchmark passages in documents, by the q-gram lemma.

A passage of m characters that stands in a text with at most k edits (insertions, deletions, changes) shares at
least m + 1 - q - k q of its q-grams with it, on diagonals that lie within a band. One of k + 1 pieces of the
passage is also there unchanged, which tells where to count: a piece met in a text opens the two overlapping
diagonal bands that hold its diagonal. Bands with enough shared q-grams are verified by a banded alignment.

Passages are the whole items and, for documents that quote a part of one, its overlapping regions of a fixed length,
each with its own edits, pieces, count and alignment. An unedited part of REGION + STRIDE - 1 characters holds one.

The benchmark's pieces are broadcast in shards of a bounded size; a larger benchmark takes more passes over the
documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import Plain, share, table
from touchline.llm.rolling import Roller, mix

#: Edits allowed, as a share of a passage's characters.
EDITS = 0.05
GRAM = 5
PIECE = 12
#: Passages below this length may not be edited; those shorter than a piece are not looked for.
SHORT = 40
#: Characters of a region of an item, and from one region's start to the next. Shorter items are only looked for whole.
REGION = 60
STRIDE = 15
#: Characters of benchmark text that are broadcast at once.
SHARD_CHARACTERS = 4 << 20

_GAPS = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    """Letters and digits in lower case, all else as one blank."""
    return _GAPS.sub(" ", (text or "").lower()).strip()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def budget(m: int, edits: float) -> int:
    return int(m * edits) if m >= SHORT else 0


@dataclass
class Item:
    item_id: object
    text: np.ndarray
    edits: int
    grams: np.ndarray


class Index:
    """The passages of a shard and their pieces by hash: whole items, and their regions of ``region`` characters."""

    def __init__(self, items: list[tuple[object, str | None]], edits: float, region: int | None = None) -> None:
        self.items: list[Item] = []
        self.region, self.region_edits = region, budget(region or 0, edits)
        roller, found = Roller(), []
        for item_id, raw in items:
            text = codes(normal(raw))
            m = len(text)
            if m < PIECE:
                continue
            k = budget(m, edits)
            number = len(self.items)
            self.items.append(Item(item_id, text, k, _grams(roller, text)))
            places = np.arange(k + 1) * (m // (k + 1))
            sums = roller.prefix(mix(text.astype(np.uint64)))
            found += [(h, number, j, False) for h, j in zip(roller.spans(sums, places, places + PIECE).tolist(), places.tolist(), strict=True)]
            if self.has_regions(number):
                own = np.arange(self.region_edits + 1) * (region // (self.region_edits + 1))
                places = np.unique(self.starts(number)[:, None] + own)
                found += [(h, number, j, True) for h, j in zip(roller.spans(sums, places, places + PIECE).tolist(), places.tolist(), strict=True)]
        found.sort()
        hashes, item, place, part = zip(*found, strict=True) if found else ((),) * 4
        self.item, self.place, self.part = np.array(item, np.int64), np.array(place, np.int64), np.array(part, bool)
        self.hashes, self.first, self.times = np.unique(np.array(hashes, np.uint64), return_index=True, return_counts=True)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def has_regions(self, number: int) -> bool:
        return self.region is not None and len(self.items[number].text) > self.region

    def starts(self, number: int) -> np.ndarray:
        """Where the regions of an item begin; the last one ends with the item."""
        last = len(self.items[number].text) - self.region
        return np.append(np.arange(0, last, STRIDE), last)

    def candidates(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, diagonal, whether of a region) of the pieces met, given the hash at each place of a text."""
        at = np.flatnonzero(self.filter[(hashes >> np.uint64(44)).astype(np.int64)])
        where = np.searchsorted(self.hashes, hashes[at])
        same = where < len(self.hashes)
        same[same] = self.hashes[where[same]] == hashes[at][same]
        at, where = at[same], where[same]
        times = self.times[where]
        flat = np.repeat(self.first[where], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return self.item[flat], np.repeat(at, times) - self.place[flat], self.part[flat]


def _grams(roller: Roller, text: np.ndarray) -> np.ndarray:
    n = max(0, len(text) - GRAM + 1)
    places = np.arange(n)
    return roller.spans(roller.prefix(mix(text.astype(np.uint64))), places, places + GRAM)


def shared_grams(item: np.ndarray, part: np.ndarray, shift: int, width: int) -> np.ndarray:
    """Which of an item's grams occur in a text's part on the diagonals shift .. shift + width - 1."""
    padded = np.zeros(len(item) + width - 1, np.uint64)
    a, b = max(0, shift), min(len(part), shift + len(padded))
    if b <= a:
        return np.zeros(len(item), bool)
    padded[a - shift : b - shift] = part[a:b]
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)
    return (rows == item[:, None]).any(axis=1)


def alignment(item: np.ndarray, part: np.ndarray, shift: int, width: int, most: int) -> tuple[int, int] | None:
    """(edits, end): the least edits that turn ``item`` into some part of ``part``, on the diagonals shift ..
    shift + width - 1, and where that ends; None above ``most``."""
    far = most + 1
    steps = np.arange(width)
    cost = np.zeros(width, np.int64)  # an empty start costs nothing on any diagonal
    cost[(steps + shift < 0) | (steps + shift > len(part))] = far
    for i, c in enumerate(item.tolist()):
        at = i + shift + steps  # the character that the diagonal step takes
        ok = (at >= 0) & (at < len(part))
        change = np.full(width, far)
        change[ok] = cost[ok] + (part[at[ok]] != c)
        drop = np.concatenate((cost[1:], [far])) + 1  # without a character of the item
        drop[at + 1 < 0] = far
        cost = np.minimum(change, drop)
        cost = np.minimum.accumulate(cost - steps) + steps  # with characters of the part more
        cost[(at + 1 < 0) | (at + 1 > len(part))] = far
        if cost.min() > most:
            return None
    best = int(cost.argmin())
    return int(cost[best]), len(item) + shift + best


def passages(index: Index, roller: Roller, text: str) -> list[tuple[object, int, int]]:
    """(item id, end, edits) of the items in a normalised text: the best place of each, of the whole item if that
    is there, else of its regions."""
    whole = codes(text)
    if len(whole) < PIECE:
        return []
    symbols = mix(whole.astype(np.uint64))
    sums = roller.prefix(symbols)
    places = np.arange(len(whole) - PIECE + 1)
    item, diagonal, part = index.candidates(roller.spans(sums, places, places + PIECE))
    best: dict[int, tuple[int, int]] = {}
    for i, b in _bands(item[~part], diagonal[~part], np.array([i.edits for i in index.items])[item[~part]]):
        found = index.items[i]
        _verify(best, i, found, roller, whole, b, found.edits, len(found.text), np.zeros(1, np.int64))
    if part.any():
        part &= ~np.isin(item, list(best))
        regions: dict[int, tuple[int, int]] = {}
        for i, b in _bands(item[part], diagonal[part], np.full(int(part.sum()), index.region_edits)):
            _verify(regions, i, index.items[i], roller, whole, b, index.region_edits, index.region, index.starts(i))
        best |= regions
    return [(index.items[i].item_id, end, e) for i, (e, end) in best.items()]


def _bands(item: np.ndarray, diagonal: np.ndarray, edits: np.ndarray) -> list[tuple[int, int]]:
    """(item, band): bands are twice as wide as the diagonals of a match can differ, and begin that far apart."""
    band = np.floor_divide(diagonal, edits + 1)
    seen = {(i, b) for i, b in zip(item.tolist(), band.tolist(), strict=True)}
    return sorted(seen | {(i, b - 1) for i, b in seen})


def _verify(best, i: int, found: Item, roller: Roller, whole: np.ndarray, band: int, k: int, m: int, starts: np.ndarray) -> None:
    """Keep in ``best`` the best place of those parts of ``m`` characters of an item, from ``starts``, that stand in
    a text with at most ``k`` edits on the diagonals of a band."""
    low, width = band * (k + 1), 2 * (k + 1)
    since = max(0, low - k)
    part = whole[since : max(since, low + width + len(found.text) + k)]
    bound = m + 1 - GRAM - k * GRAM
    if bound > 0:
        met = np.concatenate(([0], np.cumsum(shared_grams(found.grams, _grams(roller, part), low - since, width))))
        starts = starts[met[starts + m + 1 - GRAM] - met[starts] >= bound]
    for start in starts.tolist():
        # a match ends on the band at most k further on
        begin = max(0, low + start - k)
        aligned = alignment(found.text[start : start + m], whole[begin : max(begin, low + start + width + m + k)], low + start - begin, width, k)
        if aligned and (i not in best or (aligned[0], aligned[1] + begin) < best[i]):
            best[i] = (aligned[0], aligned[1] + begin)


def _matches(index, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, held = Roller(), index()
        for batch in batches:
            rows = [
                (row, *found)
                for row, text in enumerate(batch["text"].to_pylist())
                for found in passages(held, roller, normal(text))
            ]
            row, item, end, edits = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(row, pa.int64())),
                    pa.array(item, item_type),
                    pa.array(end, pa.int64()),
                    pa.array(edits, pa.int32()),
                ],
                ["doc_id", "item_id", "passage_end", "edits"],
            )

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    edits: float = EDITS,
    shard_characters: int = SHARD_CHARACTERS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, item_id, passage_end, edits): the benchmark's passages in each row of ``docs``, once a row.

    Texts are compared as letters and digits in lower case, with one blank for all between; ``passage_end`` is
    a place in that. Passages may differ by ``edits`` of their characters, those below 40 characters not at all, and
    those below 12 are not looked for. An item that is not there as a whole is met by any of its regions of 60
    characters, which start 15 apart; ``passage_end`` and ``edits`` are then those of the best region. Items of up to
    60 characters are met only whole. Null or empty texts hold nothing; of rows that repeat, each is reported; a
    null id is reported as null; an empty benchmark or table gives an empty result."""
    spark = docs.sparkSession
    plain, items = Plain(docs), Plain(benchmark)
    rows = plain.df.select(F.col(plain[id_column]).alias("doc_id"), F.col(plain[text_column]).alias("text"))
    passages_ = items.df.select(F.col(items["item_id"]).cast("long").alias("item_id"), F.col(items["text"]).alias("text"))
    size = passages_.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_characters))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = None
    for shard in range(shards):
        of = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard
        held = [(r.item_id, r.text) for r in passages_.where(of).distinct().toLocalIterator()]
        index = share(spark, Index(held, edits, REGION))
        part = rows.mapInArrow(
            _matches(index, pa.int64()), f"doc_id {id_type}, item_id long, passage_end long, edits int"
        )
        found = part if found is None else found.unionByName(part)
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, shard_characters: int = SHARD_CHARACTERS, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with all their columns."""
    spark = docs.sparkSession
    items = Plain(benchmark)
    texts = items.df.select(F.col(items["text"]).alias("text"))
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_characters))
    kept = Plain(docs)
    text, rows = kept[text_column], kept.df
    for shard in range(shards):
        held = texts.where(F.pmod(F.xxhash64("text"), F.lit(shards)) == shard).distinct().toLocalIterator()
        index = share(spark, Index([(None, r.text) for r in held], edits, REGION))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            roller, shard_index = Roller(), index()
            for batch in batches:
                clean = [not passages(shard_index, roller, normal(t)) for t in batch[text].to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        rows = rows.mapInArrow(run, rows.schema)
    return kept.restore(rows)


def op6_qgram_decontamination(spark, sf_dir) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
