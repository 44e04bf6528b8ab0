"""Jaccard join of word shingles by vertical partitioning, and the groups that its links make.

All shingles have one global order, the rare ones first as far as a small table of counts can tell; a key holds a
shingle's place in it. The order is cut into fragments. A pair's overlap is counted fragment by fragment, each from
its own part of both sets, and the parts are summed per pair.

Texts with equal sets are one class. Two linked sets share some of the first keys of either: at least m of the first
(as many as may be missing, and m). A set of which fewer than m first keys occur in other sets is linked with none.
The others drop the most frequent of their first keys, up to m - 1, which leaves every linked pair one in
common; what remains of those keys gives the candidates. As groups are wanted, not all links within
them, a key's classes are compared with a few centres of that key at a time, and pairs whose classes are joined by
then are left out, as are those that differ too much by size or by a signature of their sets. A few rounds take more
centres each; the last one takes all classes that are not in one group yet and that size and signature don't tell
apart, each such pair once. No link between groups is missed, and a large group of copies costs as many pairs as it has
members. Classes have numbers, and only the sets of a round's pairs are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import BitFilter, Plain, arrow_bytes, released, share, sum_slices, table, text_key
from touchline.llm.recurrence import HASHED, chunks
from touchline.llm.rolling import Roller, mix
from touchline.session import arrow_batches, written

SHINGLE = 4
PERCENT = 85
FRAGMENTS = 4
#: Cells of the table of counts. It orders shingles and decides nothing, so its size is fixed.
CELLS = 1 << 18
SLICES = 16
#: Sets take one first key more, and share one more, for each so many shingles.
SPARE = 20
#: Bytes of text that go to Python at once.
BATCH = 4 << 20
#: 64-bit words of a set's signature.
SIGNS = 8
#: Centres of a key in each round. 0: each class is compared with one centre only; None: with all that are left.
CENTRES = (0, 1, 16, None)


def _shingles(roller: Roller, texts: list[bytes], size: int) -> list[np.ndarray]:
    """The set of shingles of each text, as hashes."""
    held = np.frombuffer(b"\n".join(texts), np.uint8).copy()
    held[(held >= 65) & (held <= 90)] += 32
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    hashes, start, _ = roller.words(held)
    until = np.searchsorted(start, ends)
    since = np.concatenate(([0], until[:-1]))
    sums = roller.prefix(hashes)
    places = np.arange(max(0, len(hashes) - size + 1))
    grams = roller.spans(sums, places, places + size)
    out = []
    for a, b in zip(since.tolist(), until.tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(roller.spans(sums, np.array([a]), np.array([b])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _name(shingles: np.ndarray) -> tuple[int, int]:
    """Two numbers that stand for a set."""
    with np.errstate(over="ignore"):
        a, b = (mix(shingles ^ np.uint64(salt)).sum(dtype=np.uint64) for salt in (0x51ED270B, 0xA3C59AC3F1))
    return int(np.uint64(a).view(np.int64)), int(np.uint64(b).view(np.int64))


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            rows = [
                (len(s), *_name(s)) for _, texts in chunks(arrow_bytes(batch["text"]), HASHED) for s in _shingles(roller, texts, size)
            ]
            columns = zip(*rows, strict=True) if rows else ((),) * 3
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(x, pa.int64()) for x in columns]], ["doc_id", "n", "a", "b"]
            )

    return run


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(20)) & np.uint64(CELLS - 1)


def _counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, met = Roller(), np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, texts in chunks(arrow_bytes(batch["text"]), HASHED):
                met += np.bincount(_cell(np.concatenate(_shingles(roller, texts, size))).astype(np.int64), minlength=CELLS)
        parts = [x.tobytes() for x in np.split(met, SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], ["slice", "data"])

    return run


class Order:
    """The global order: how common a shingle is, in powers of two, and then its hash."""

    def __init__(self, met: np.ndarray, fragments: int) -> None:
        self.level = np.log2(np.maximum(met, 1)).astype(np.uint64)
        mass = np.bincount(self.level.astype(np.int64), weights=met, minlength=64)
        until = np.cumsum(mass) / max(1, mass.sum())
        self.cuts = []
        for f in range(1, fragments):
            level = min(63, int(np.searchsorted(until, f / fragments)))
            share = (f / fragments - (until[level - 1] if level else 0)) / max(mass[level] / max(1, mass.sum()), 1e-12)
            self.cuts.append((level << 58) + int(min(share, 1) * ((1 << 58) - 1)))

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Sorted, below 2**63 and so the same as signed numbers."""
        return np.sort((self.level[_cell(shingles).astype(np.int64)] << np.uint64(58)) | (mix(shingles) >> np.uint64(6)))


def _least(n, percent: int):
    """The least overlap of a set of ``n`` with any set that it is linked to."""
    return -(-percent * n // 100)


def _common(n):
    """How many of the first keys two linked sets share, if the smaller has ``n``."""
    return 1 + n // SPARE


def _first(n: int, percent: int) -> int:
    """How many first keys a set of ``n`` takes, to share ``_common`` with those of any set that it is linked to."""
    return n - _least(n, percent) + _common(n) if n else 0


def _keys(size: int, percent: int, order):
    """The first keys of each text's set, with its name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, keys = Roller(), order().keys
        for batch in batches:
            for _, texts in chunks(arrow_bytes(batch["text"]), HASHED):
                sets = _shingles(roller, texts, size)
                firsts = [keys(s)[: _first(len(s), percent)] for s in sets]
                names = np.repeat(np.array([_name(s)[0] for s in sets], np.int64), [len(x) for x in firsts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts).view(np.int64)), pa.array(names)], ["key", "a"]
                )

    return run


CLASSES = "a long, b long, n long, signs array<long>, keys array<long>, parts array<array<long>>"


def _signs(shingles: np.ndarray) -> np.ndarray:
    """A signature of bits, each telling whether an odd number of shingles fall on it. Two sets differ in at least
    as many shingles as their signatures do in bits."""
    met = np.bincount((mix(shingles + np.uint64(99)) % np.uint64(64 * SIGNS)).astype(np.int64), minlength=64 * SIGNS)
    return np.packbits((met & 1).astype(np.uint8)).view(np.int64)


def _classes(size: int, percent: int, order, shared):
    """The sets that share enough first keys with others, once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, seen = Roller(), set()
        ordered, known = order(), shared()
        pivots = np.array(ordered.cuts, np.uint64)
        for batch in batches:
            for _, texts in chunks(arrow_bytes(batch["text"]), HASHED):
                rows = []
                for s in _shingles(roller, texts, size):
                    keys = ordered.keys(s)
                    first = keys[: _first(len(s), percent)]
                    first = first[known.may_hold(first)]
                    name = _name(s)
                    # the smallest set that this one can be linked to shares so many
                    if len(s) and len(first) >= _common(_least(len(s), percent)) and name not in seen:
                        seen.add(name)
                        cuts = np.searchsorted(keys, pivots)
                        parts = [x.view(np.int64) for x in np.split(keys, cuts)]
                        rows.append((*name, len(s), _signs(s), first.view(np.int64), parts))
                if len(seen) > 1_000_000:
                    seen.clear()
                a, b, n, signs, firsts, parts = zip(*rows, strict=True) if rows else ((),) * 6
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x, pa.int64()) for x in (a, b, n)], pa.array(signs, longs), pa.array(firsts, longs), pa.array(parts, pa.list_(longs))],
                    ["a", "b", "n", "signs", "keys", "parts"],
                )

    return run


def _as(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])


def links(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (x, y) whose sets have ``percent`` of their union in common. ``parts`` holds the
    fragments of each set: (id, n, fragment, part). The larger side of a pair travels once a fragment."""
    x, y = _as(parts, "x"), _as(parts, "y")
    counted = (
        pairs.join(y, pairs["y"] == y["y_id"])
        .join(x, (F.col("x") == F.col("x_id")) & (F.col("x_fragment") == F.col("y_fragment")))
        .select("x", "y", "x_n", "y_n", F.size(F.array_intersect("x_part", "y_part")).cast("long").alias("overlap"))
    )
    common = F.sum("overlap")
    return (
        counted.groupBy("x", "y")
        .agg(common.alias("common"), F.max("x_n").alias("x_n"), F.max("y_n").alias("y_n"))
        .where(F.col("common") * 100 >= (F.col("x_n") + F.col("y_n") - F.col("common")) * percent)
        .select("x", "y")
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for the ends of the edges (x, y): the least id that can be reached. Each round takes the least
    label among neighbours and then the label's own, so that long chains take few rounds."""
    both = written(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = written(both.groupBy(F.col("x").alias("id")).agg(F.least(F.col("x"), F.min("y")).alias("label")))
    while True:
        theirs = labels.select(F.col("id").alias("y"), F.col("label").alias("theirs"))
        nearest = both.join(theirs, "y").groupBy(F.col("x").alias("id")).agg(F.min("theirs").alias("theirs"))
        lower = labels.join(nearest, "id").select("id", "label", F.least("label", "theirs").alias("lower"))
        jump = labels.select(F.col("id").alias("lower"), F.col("label").alias("jumped"))
        least = F.least("lower", "jumped")
        after = written(lower.join(jump, "lower").select("id", least.alias("label"), (least < F.col("label")).alias("moved")))
        labels = after.select("id", "label")
        if not after.where("moved").limit(1).count():
            return labels


def _may_be_linked(x: Column, y: Column, percent: int) -> Column:
    """By size and signature. Linked sets differ in at most this part of the sum of their sizes."""
    apart = sum((F.bit_count(x[f"s{i}"].bitwiseXOR(y[f"s{i}"])) for i in range(SIGNS)), F.lit(0))
    sizes = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent
    return sizes & (apart * (100 + percent) <= (x["n"] + y["n"]) * (100 - percent))


def _common_column(n: Column) -> Column:
    return 1 + F.floor(n / SPARE)


def _thin(classes: DataFrame, percent: int) -> DataFrame:
    """(key, id): the first keys of each class that other classes have too, without the most frequent ones.

    Two linked classes share at least m of them. Both leave out up to m - 1, the most frequent by one order of all keys.
    For the rarest key that they share to go, the others that they share would have to go before it, and these are m - 1:
    so it stays with either."""
    keys = classes.select(F.explode("keys").alias("key"), "id", "n")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # a class has no more rows here than its text has shingles
    frequent = Window.partitionBy("id").orderBy(F.desc("size"), "key")
    spared = _common_column(F.ceil(F.col("n") * percent / 100)) - 1
    return keys.join(sizes, "key").withColumn("place", F.row_number().over(frequent)).where(F.col("place") > spared).select("key", "id")


def _left_pairs(labelled: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """(x, y): the classes of a key in (key, id, label) that may be linked and have different labels. A pair is made at
    the least key that both have, and so once, however many keys it shares."""
    own = labelled.groupBy("id").agg(F.collect_list("key").alias("keys"))
    rows = labelled.join(about, "id").join(own, "id")
    others = _as(rows, "other")
    apart = (F.col("other_label") != F.col("label")) & (F.col("other_id") < F.col("id")) & _may_be_linked(F.col("other_about"), F.col("about"), percent)
    least = F.array_min(F.array_intersect("keys", "other_keys")) == F.col("key")
    return rows.join(others, (F.col("key") == F.col("other_key")) & apart & least).select(F.col("other_id").alias("x"), F.col("id").alias("y"))


def _grouped(classes: DataFrame, percent: int) -> DataFrame | None:
    """(id, label) of the classes that are linked to others; None if there are none."""
    about = classes.select("id", F.struct("n", *[F.col("signs")[i].alias(f"s{i}") for i in range(SIGNS)]).alias("about"))
    buckets = written(_thin(classes, percent))
    labels: DataFrame | None = None
    for centres in CENTRES:
        labelled = buckets.withColumn("label", F.col("id"))
        if labels is not None:
            mine = labels.withColumnRenamed("label", "own")
            labelled = buckets.join(mine, "id", "left").select("key", "id", F.coalesce("own", "id").alias("label"))
        # keys whose classes are not in one group yet
        open_keys = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        labelled = written(labelled.join(open_keys.select("key"), "key"))
        if labelled.isEmpty():
            break
        if centres is None:
            pairs = _left_pairs(labelled, about, percent)
        else:
            part = F.pmod(F.xxhash64("id"), F.lit(max(1, centres)))
            chosen = labelled.groupBy("key", part.alias("part")).agg(F.min(F.struct("id", "label")).alias("centre")).select("key", "centre.*")
            centre = _as(chosen.join(about, "id"), "centre")
            apart = (F.col("centre_label") != F.col("label")) & _may_be_linked(F.col("centre_about"), F.col("about"), percent)
            met = labelled.join(about, "id").join(centre, (F.col("key") == F.col("centre_key")) & apart)
            if centres == 0:
                pairs = met.groupBy(F.col("id").alias("y")).agg(F.min("centre_id").alias("x")).select("x", "y")
            else:
                # a pair is told by its lower end, whichever of the two is the centre
                pairs = met.select(F.least("id", "centre_id").alias("x"), F.greatest("id", "centre_id").alias("y")).distinct()
        pairs = written(pairs)
        found = None
        if not pairs.isEmpty():
            # only the sets of these pairs travel
            needed = written(pairs.select(F.col("x").alias("id")).unionByName(pairs.select(F.col("y").alias("id"))).distinct())
            parts = classes.join(needed, "id", "left_semi").select("id", "n", F.posexplode("parts").alias("fragment", "part"))
            found = written(links(pairs, parts, percent))
        if found is not None and not found.isEmpty():
            # what earlier links made is one edge from each class to the least of its group
            edges = found if labels is None else found.unionByName(labels.where("id != label").select(F.col("label").alias("x"), F.col("id").alias("y")))
            labels = components(edges)
        buckets = labelled.select("key", "id")
        if centres:
            # a centre has now met all classes of its key
            buckets = buckets.join(chosen.select("key", "id"), ["key", "id"], "left_anti")
    return labels


def jaccard_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    fragments: int = FRAGMENTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text's set holds its different shingles of
    ``shingle`` words, or with fewer words all of them as one. Two texts are linked when their sets share
    ``percent`` hundredths of their union; ``component_id`` is the smallest id that links reach. A null, empty or
    blank text has an empty set and is linked with nothing, so that its id is its own component. Rows that repeat
    are linked as any equal texts are. A component without any id has a null one."""
    spark = docs.sparkSession
    plain = Plain(docs)
    rows = plain.df.select(F.col(plain[id_column]).alias("doc_id"), F.col(plain[text_column]).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    texts = rows.select("text")

    with arrow_batches(spark, BATCH):
        sets = written(rows.mapInArrow(released(_sets(shingle)), f"doc_id {id_type}, n long, a long, b long"))
        met = sum_slices(texts.mapInArrow(released(_counts(shingle)), "slice int, data binary"), SLICES, np.int64)
        order = share(spark, Order(np.concatenate(met) if met else np.zeros(CELLS), fragments))

        shared = written(
            texts.mapInArrow(released(_keys(shingle, percent, order)), "key long, a long")
            .groupBy("key")
            .agg(F.min("a").alias("low"), F.max("a").alias("high"))
            .where("low < high")
            .select("key")
        )
        held = share(spark, BitFilter.of(shared, "key", shared.count()))
        found = texts.mapInArrow(released(_classes(shingle, percent, order, held)), CLASSES)
        # numbered, so that rows of keys and pairs are small; once written, a number stays
        classes = written(
            found.groupBy("a", "b")
            .agg(*[F.first(c).alias(c) for c in ("n", "signs", "keys", "parts")])
            .withColumn("id", F.monotonically_increasing_id())
        )
    labels = _grouped(classes, percent)

    smallest = sets.where("n > 0").groupBy("a", "b").agg(F.min("doc_id").alias("smallest"))
    if labels is not None:
        named = labels.join(classes.select("id", "a", "b"), "id").select("a", "b", "label")
        of = written(smallest.join(named, ["a", "b"], "left").select("a", "b", "label", "smallest"))
        grouped = of.where("label IS NOT NULL")
        per_label = grouped.groupBy("label").agg(F.min("smallest").alias("smallest"))
        smallest = of.where("label IS NULL").drop("label").unionByName(
            grouped.select("a", "b", "label").join(per_label, "label").select("a", "b", "smallest")
        )
    component = F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    return sets.join(smallest, ["a", "b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without those that another of their group stands for: of each group the rows with the
    smallest id stay, and so do rows without words or without an id. A group whose rows have no id at all stays whole.
    It is a row that goes, not an id: of rows that share an id and have different texts, each is judged by its own
    text's group. Rows that repeat both are judged alike."""
    plain = Plain(docs)
    k0, k1 = text_key(F.col(plain[text_column]))
    rows = plain.df.select("*", k0.alias("text_k0"), k1.alias("text_k1"))
    own_id = F.col(plain[id_column])
    # a row without id is none that a group can be named by
    row = F.when(own_id.isNotNull(), F.struct(own_id.alias("id"), "text_k0", "text_k1"))
    grouped = jaccard_groups(rows.select(row.alias("row"), F.col(plain[text_column]).alias("text")), id_column="row", text_column="text", **options)
    # a group is named by its smallest row; the id in it is the smallest of the group
    gone = grouped.where(F.col("doc_id.id") != F.col("component_id.id")).select(
        F.col("doc_id.id").alias("gone_id"), F.col("doc_id.text_k0").alias("gone_k0"), F.col("doc_id.text_k1").alias("gone_k1")
    )
    # written, so that texts are not shuffled where these are few
    gone = written(gone.distinct())
    same = (plain.df[plain[id_column]] == F.col("gone_id")) & (F.col("text_k0") == F.col("gone_k0")) & (F.col("text_k1") == F.col("gone_k1"))
    return plain.restore(rows.join(gone, same, "left_anti"))


def op8_vertical_jaccard(spark, sf_dir) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE held AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                                 ELSE [array_to_string(words[i : i + 3], ' ') FOR i IN range(1, len(words) - 2)] END) AS shingle
  FROM held
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY x, y
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)
), ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT r.doc_id, w.y FROM reached r JOIN ways w ON w.x = r.other
), least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""
