"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

Which strings may recur, and where, comes from ``recurrence``: its buckets hold, for some anchors, the different byte
strings around each. Equal windows lie at the same distance from their anchor. So a string is read as blocks of
bytes counted from its anchor, a block's symbol standing for its bytes, its anchor and its distance, and a suffix
begins at a block. A bucket's strings are cut into shards; each shard's suffixes are sorted and give its transform,
and the transforms are merged by refining their interleave one symbol at a time, which also yields the common
prefixes. No suffixes of different shards are compared or sorted again.

A suffix that shares the blocks of a whole window with another starts a window that recurs, and one more shared
block settles all windows up to the next suffix. Only the windows at the edge of a shared part are left; those are
compared by hash among the strings whose suffix shares all blocks but one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchline.llm.common import arrow_bytes, table
from touchline.llm.recurrence import Windows, marked, with_spans
from touchline.llm.rolling import Roller, mix

BYTES = 400
ANCHOR_BYTES = 64
#: Strings in a bucket and symbols in a shard.
BUCKET_STRINGS = 4000
SHARD_SYMBOLS = 1 << 15
#: Bytes in a block; the largest divisor of the window up to this is taken.
MOST_BLOCK = 16


def _order(keys: np.ndarray) -> np.ndarray:
    """A stable sorting order of numbers below 2**31."""
    n = len(keys)
    if n < 2:
        return np.arange(n)
    return (np.sort((keys.astype(np.uint64) << np.uint64(32)) | np.arange(n, dtype=np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffixes of a sequence of strings, each ended by 0, in order. A suffix ends at its string's 0; equal
    suffixes stay in the order of their places. By doubling the sorted length."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    ends = np.flatnonzero(symbols == 0)
    # symbols to the string's end
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    width = 1
    longest = int(left.max(initial=0)) + 1
    while True:
        rank = np.unique(rank, return_inverse=True)[1]
        if width >= longest:
            return _order(rank)
        after = np.where(left >= width, rank[np.minimum(np.arange(n) + width, n - 1)] + 1, 0)
        rank = rank * np.int64(n + 2) + after
        width *= 2


def merge_transforms(transforms: list[np.ndarray], strings: list[int], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave the suffixes of shards, in order of their first ``depth`` symbols.

    ``transforms`` holds, for each shard, the symbol before each suffix in the shard's order (0 before a string's
    start); ``strings`` the shards' numbers of strings. Gives, for each place of the merged order, the number of
    the suffix among all shards' suffixes one after another, and how many symbols, up to ``depth``, it shares with
    the place before.

    A round takes the order by k symbols to that by k + 1: a suffix is its first symbol and a shorter suffix, and
    the first symbols of the suffixes are those before the shorter ones, so a stable sort by symbol places them.
    Within a shard the order never changes, so an interleave is told by the shards' numbers alone."""
    sizes = [len(t) for t in transforms]
    n = sum(sizes)
    before = np.concatenate(transforms)
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint16), sizes)
    ended = np.repeat(np.arange(len(transforms), dtype=np.uint16), strings)
    block = np.zeros(n, np.int64)
    edge = np.zeros(n, bool)
    if n:
        edge[0] = True
    shared = np.full(n, depth, np.int32)
    shared[:1] = 0

    def numbers() -> np.ndarray:
        out = np.empty(n, np.int64)
        out[np.argsort(shard, kind="stable")] = np.arange(n)
        return out

    for k in range(depth):
        symbol = before[numbers()]
        inner = np.flatnonzero(symbol)
        order = inner[_order(symbol[inner])]
        # suffixes that are an end alone come first, shard by shard, and share nothing with each other
        shard, old = np.concatenate((ended, shard[order])), block[order]
        first, m = symbol[order], len(ended)
        new = np.ones(n, bool)
        if n > m + 1:
            new[m + 1 :] = (first[1:] != first[:-1]) | (old[1:] != old[:-1])
        fresh = new & ~edge
        shared[fresh] = k
        if k and not fresh.any():
            break
        edge = new
        block = np.cumsum(new)
    return numbers(), shared


def _bucket_windows(roller: Roller, size: int, block: int, bucket: pa.Table, shard_symbols: int) -> list[np.ndarray]:
    """Which windows recur, for each string of a bucket."""
    covers = bucket["cover"].to_pylist()
    anchor = bucket["anchor"].to_numpy()
    left = bucket["left"].to_numpy().astype(np.int64)
    times = bucket["times"].to_numpy()
    length = np.array([len(c) for c in covers], np.int64)
    count = length - size + 1
    base = np.concatenate(([0], np.cumsum(length)))[:-1]
    sums = roller.prefix(roller.bytes[np.frombuffer(b"".join(covers), np.uint8)])

    # symbols: the blocks of each string and a 0
    ahead = left % block  # bytes before the first block
    blocks = (length - ahead) // block
    head = np.concatenate(([0], np.cumsum(blocks + 1)))
    n = int(head[-1])
    string = np.repeat(np.arange(len(covers)), blocks + 1)
    nth = np.arange(n) - head[string]
    real = nth < blocks[string]
    at = base[string] + ahead[string] + nth * block
    at_real = at[real]
    place = (nth - left[string] // block)[real]
    key = mix(roller.spans(sums, at_real, at_real + block) ^ mix(anchor[string][real].view(np.uint64) + place.astype(np.uint64)))
    symbols = np.zeros(n, np.int64)
    symbols[real] = np.unique(key, return_inverse=True)[1] + 1

    # shards of whole strings, their sorted suffixes and transforms
    of = head[:-1] // shard_symbols
    firsts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    suffixes, transforms, strings = [], [], []
    for a, b in zip(firsts, [*firsts[1:], len(covers)], strict=True):
        part = symbols[head[a] : head[b]]
        order = suffix_order(part)
        before = np.concatenate(([0], part[:-1]))
        suffixes.append(order + head[a])
        transforms.append(before[order])
        strings.append(int(b - a))
    whole = size // block
    number, shared = merge_transforms(transforms, strings, whole + 1)
    with_next = np.concatenate((shared[1:], [0]))
    most = np.zeros(n + 1, np.int32)  # blocks that a suffix shares with any other
    most[np.concatenate(suffixes)[number]] = np.maximum(shared, with_next)

    # windows in order: that of byte s lies in the gap before suffix j or starts at it
    row = np.repeat(np.arange(len(covers)), count)
    s = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    j = (s - ahead[row]) // block  # the suffix at or before it; -1: none
    exact = (s - ahead[row]) % block == 0
    here = np.where(j >= 0, most[np.maximum(head[row] + j, 0)], 0)
    after = np.where(j + 1 < blocks[row], most[np.minimum(head[row] + j + 1, n)], 0)
    recurs = (times[row] > 1) | (here > whole) | (exact & (here >= whole))
    open_ = ~recurs & ~exact & (after >= whole - 1)
    if open_.any():
        # all windows that may equal an open one, those known to recur included
        some = np.flatnonzero(~exact & (after >= whole - 1))
        hashes = roller.spans(sums, base[row[some]] + s[some], base[row[some]] + s[some] + size)
        hashes = mix(hashes ^ mix(anchor[row[some]].view(np.uint64) + (s[some] - left[row[some]]).astype(np.uint64)))
        _, kind = np.unique(hashes, return_inverse=True)
        recurs[some] |= np.bincount(kind, weights=times[row[some]])[kind] > 1
    return np.split(recurs, np.cumsum(count)[:-1])


def locate_strings(size: int, shard_symbols: int = SHARD_SYMBOLS):
    """For a bucket's strings: which windows of ``size`` bytes recur."""
    block = max(b for b in range(1, MOST_BLOCK + 1) if size % b == 0)

    def run(bucket: pa.Table) -> pa.Table:
        found = _bucket_windows(Roller(), size, block, bucket, shard_symbols)
        masks = pa.array([np.packbits(x).tobytes() for x in found], pa.binary())
        return pa.table({"anchor": bucket["anchor"], "context": bucket["context"], "mask": masks})

    return run


def _kept(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, runs, kept = [], [], [], []
            for text, spans in zip(arrow_bytes(batch["text"]), batch["spans"].to_pylist(), strict=True):
                gone = marked(len(text), size, spans)
                counts.append(len(text))
                removed.append(int(gone.sum()))
                runs.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes() if removed[-1] else text)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(x, pa.int64()) for x in (counts, removed, runs)], pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_strings(
    docs: DataFrame,
    size: int = BYTES,
    anchor_bytes: int = ANCHOR_BYTES,
    bucket_strings: int = BUCKET_STRINGS,
    shard_symbols: int = SHARD_SYMBOLS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (binary: the kept bytes).

    Texts are taken as UTF-8. A byte goes if a string of ``size`` bytes that covers it occurs at any other place,
    in the same document or another, overlapping places included. Strings are judged on the whole input. A null
    text is an empty one; texts shorter than ``size`` keep all; rows that repeat lose all such strings. As a cut
    may fall inside a character, the kept bytes need not be UTF-8."""
    windows = Windows(False, size, min(anchor_bytes, size))
    rows = with_spans(docs, windows, locate_strings(size, shard_symbols), id_column, text_column, bucket_strings)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_kept(size), f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")


def op10_bwt_dedup(spark, sf_dir) -> DataFrame:
    found = remove_strings(table(spark, sf_dir, "documents"))
    return found.selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS kept_sha256")
