"""Which windows of a fixed number of symbols (words or bytes) occur more than once, over all documents.

1. Each window has an anchor: its least hash of a few symbols. Windows in a row that share an anchor are a run, and
   equal windows have equal anchors, so that only runs with equal anchors can hold equal windows. One aggregate by
   anchor leaves the anchors that recur; those that occur once end here.
2. The runs at recurring anchors are written: where they are, and for anchors whose runs differ (``mixed``) what
   they cover, once for each different run in a task. Where all runs of an anchor are alike, all windows recur.
3. Of a mixed anchor, the different runs (with their number) go to a bucket of a few thousand, where ``locate``
   finds the windows that recur. It is what the operators differ in. An anchor with more different runs than fit
   in a bucket is not collected: its windows are counted by hash, in a plain aggregate.
4. What was found goes back to the documents by the hash of their text.

Rows shuffled are those of anchors (about one for every 13 words or 130 bytes), of the different runs at mixed
anchors, and the documents themselves once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import BitFilter, Plain, arrow_bytes, share, text_key
from touchline.llm.rolling import Roller
from touchline.session import written

#: Bytes of text hashed at once; a longer text is hashed alone.
CHUNK = 1 << 20
#: The same where nothing is gained by more: each byte becomes several numbers meanwhile.
HASHED = 1 << 18
#: Symbols of a text hashed at once; longer texts are taken in overlapping parts.
PART = 1 << 20
#: Different runs in a bucket, on average, and of one anchor at most.
BUCKET_RUNS = 4000


@dataclass(frozen=True)
class Windows:
    """What counts as a passage: ``size`` symbols in a row; anchors are hashes of ``gram`` symbols."""

    words: bool
    size: int
    gram: int

    def __post_init__(self) -> None:
        if not 1 <= self.gram <= self.size:
            raise ValueError("a window must hold at least one gram")


@dataclass
class Runs:
    """The runs of some texts. Places are counted from the start of a text, in symbols."""

    text: np.ndarray
    anchor: np.ndarray
    place: np.ndarray
    first: np.ndarray
    count: np.ndarray
    context: np.ndarray
    cover: Callable[[int], bytes]


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Parts of a list, of about ``limit`` bytes, with the number of the first text."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(t) + 1
    if begin < len(texts):
        yield begin, texts[begin:]


def runs_of(roller: Roller, windows: Windows, texts: list[bytes]) -> Runs:
    held = b"\n".join(texts)
    buffer = np.frombuffer(held, np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    if windows.words:
        symbols, start, end = roller.words(buffer)
        begins, ends = np.searchsorted(start, begins), np.searchsorted(start, ends)
    else:
        symbols = buffer
    # a byte at an end is the line end between two texts; a word at an end is the next text's first
    side = "right" if windows.words else "left"

    def text_of(at: np.ndarray) -> np.ndarray:
        return np.searchsorted(ends, at, side=side)

    found = []
    for a in range(0, len(symbols), PART):
        part = symbols[a : a + PART + windows.size - 1]
        until = np.minimum(ends[text_of(np.arange(a, a + len(part)))] - a, len(part))
        if not windows.words:
            part = roller.bytes[part]
        anchor, place, first, final, context = roller.anchors(part, until, windows.size, windows.gram)
        found.append((anchor, place + a, first + a, final - first + 1, context))
    anchor, place, first, count, context = (
        (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 5
    )
    text = text_of(first)

    def cover(i: int) -> bytes:
        a, b = int(first[i]), int(first[i] + count[i]) + windows.size - 1
        if windows.words:
            return b" ".join(held[int(start[a]) : int(end[b - 1])].split())
        return held[a:b]

    base = begins[text] if len(first) else first
    return Runs(text, anchor.view(np.int64), place - base, first - base, count, context.view(np.int64), cover)


def _anchors(windows: Windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            for _, texts in chunks(arrow_bytes(batch["text"])):
                runs = runs_of(roller, windows, texts)
                yield pa.RecordBatch.from_arrays([pa.array(runs.anchor), pa.array(runs.context)], ["anchor", "context"])

    return run


RUNS = "k0 long, k1 long, anchor long, context long, first int, count int, left int, cover binary"
#: Different runs that a task remembers to have written.
REMEMBERED = 500_000


def _runs(windows: Windows, recurring, mixed):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        one, several = recurring(), mixed()
        seen: set[int] = set()
        for batch in batches:
            keys = [batch[k].to_numpy() for k in ("k0", "k1")]
            for begin, texts in chunks(arrow_bytes(batch["text"])):
                runs = runs_of(roller, windows, texts)
                keep = np.flatnonzero(one.may_hold(runs.anchor))
                covers: list[bytes | None] = [None] * len(keep)
                if len(seen) > REMEMBERED:
                    seen.clear()
                for j in np.flatnonzero(several.may_hold(runs.anchor[keep])).tolist():
                    context = int(runs.context[keep[j]])
                    if context not in seen:
                        seen.add(context)
                        covers[j] = runs.cover(keep[j])
                text = runs.text[keep] + begin
                small = [(x[keep]).astype(np.int32) for x in (runs.first, runs.count, runs.place - runs.first)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array(k[text]) for k in keys],
                        pa.array(runs.anchor[keep]),
                        pa.array(runs.context[keep]),
                        *map(pa.array, small),
                        pa.array(covers, pa.binary()),
                    ],
                    ["k0", "k1", "anchor", "context", "first", "count", "left", "cover"],
                )

    return run


def _windows(windows: Windows):
    """The windows of runs, by hash and place before the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            covers = batch["cover"].to_pylist()
            for row, cover in enumerate(covers):
                buffer = np.frombuffer(cover, np.uint8)
                symbols = roller.words(buffer)[0] if windows.words else roller.bytes[buffer]
                first = np.arange(len(symbols) - windows.size + 1)
                hashes = roller.spans(roller.prefix(symbols), first, first + windows.size)
                n = len(first)
                same = pa.array(np.full(n, row))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch[c].take(same) for c in ("anchor", "context", "times")],
                        pa.array(first.astype(np.int32)),
                        pa.array(hashes.view(np.int64)),
                    ],
                    ["anchor", "context", "times", "window", "hash"],
                )

    return run


def find(
    docs: DataFrame,
    windows: Windows,
    locate: Callable[[pa.Table], pa.Table],
    bucket_runs: int = BUCKET_RUNS,
) -> DataFrame:
    """(k0, k1, spans): for each text with windows that recur, under its two hashes, what ``marked`` needs.

    ``docs`` has the columns text, k0 and k1. ``locate`` gets a bucket (anchor, context, times, left, count, cover)
    and gives (anchor, context, mask): ``mask`` has a bit for each of a run's ``count`` windows."""
    spark = docs.sparkSession
    met = docs.select("text").mapInArrow(_anchors(windows), "anchor long, context long")
    recurring = written(
        met.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("times"), (F.min("context") != F.max("context")).alias("mixed"))
        .where("times > 1")
        .select("anchor", "mixed")
    )
    several = recurring.where("mixed").select("anchor")
    filters = [share(spark, BitFilter.of(x, "anchor", x.count())) for x in (recurring, several)]
    runs = written(docs.select("k0", "k1", "text").mapInArrow(_runs(windows, *filters), RUNS))

    # The runs of mixed anchors, each different one once, with the number of its occurrences.
    different = written(
        runs.groupBy("anchor", "context")
        .agg(
            F.count(F.lit(1)).alias("times"),
            F.max("left").alias("left"),
            F.max("count").alias("count"),
            F.first("cover", ignorenulls=True).alias("cover"),
        )
        .where(F.col("cover").isNotNull())
        .join(several, "anchor")
    )
    per_anchor = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("runs"))
    large = per_anchor.where(F.col("runs") > bucket_runs).select("anchor")

    buckets = max(1, -(-different.count() // bucket_runs))
    located = (
        different.join(large, "anchor", "left_anti")
        .withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)).cast("int"))
        .repartition(buckets, "bucket")
        .groupBy("bucket")
        .applyInArrow(locate, "anchor long, context long, mask binary")
    )
    each = (
        different.join(large, "anchor", "left_semi")
        .select("anchor", "context", "times", "cover")
        .mapInArrow(_windows(windows), "anchor long, context long, times long, window int, hash long")
    )
    again = each.groupBy("anchor", "hash").agg(F.sum("times").alias("all")).where("all > 1").select("anchor", "hash")
    counted = each.join(again, ["anchor", "hash"]).groupBy("anchor", "context").agg(F.collect_set("window").alias("windows"))

    verdicts = located.select("anchor", "context", "mask", F.lit(None).cast("array<int>").alias("windows")).unionByName(
        counted.select("anchor", "context", F.lit(None).cast("binary").alias("mask"), "windows")
    )
    alike = runs.join(recurring.where("not mixed").select("anchor"), "anchor").select(
        "k0", "k1", "first", "count", F.lit(None).cast("binary").alias("mask"), F.lit(None).cast("array<int>").alias("windows")
    )
    spans = alike.unionByName(
        runs.join(verdicts, ["anchor", "context"]).select("k0", "k1", "first", "count", "mask", "windows")
    )
    # Copies of a text have the same spans, so the set holds no more than one text's.
    return spans.groupBy("k0", "k1").agg(F.collect_set(F.struct("first", "count", "mask", "windows")).alias("spans"))


def marked(n: int, size: int, spans: list[dict] | None) -> np.ndarray:
    """Which of a text's ``n`` symbols lie in a window that recurs."""
    edge = np.zeros(n + 1, np.int32)
    for span in spans or ():
        first, count = span["first"], span["count"]
        if span["windows"] is not None:
            starts = np.array(span["windows"], np.int64) + first
        elif span["mask"] is not None:
            starts = np.flatnonzero(np.unpackbits(np.frombuffer(span["mask"], np.uint8), count=count)) + first
        else:  # all of them
            edge[first] += 1
            edge[first + count + size - 1] -= 1
            continue
        edge[starts] += 1
        np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:-1]) > 0


def with_spans(
    docs: DataFrame, windows: Windows, locate, id_column: str, text_column: str, bucket_runs: int = BUCKET_RUNS
) -> DataFrame:
    """(doc_id, text, spans) for each row of ``docs``; a null text is an empty one."""
    plain = Plain(docs)
    text = F.coalesce(F.col(plain[text_column]), F.lit(""))
    rows = plain.df.select(F.col(plain[id_column]).alias("doc_id"), text.alias("text"))
    k0, k1 = text_key(F.col("text"))
    rows = rows.select("doc_id", "text", k0.alias("k0"), k1.alias("k1"))
    return rows.join(find(rows, windows, locate, bucket_runs), ["k0", "k1"], "left").select("doc_id", "text", "spans")
