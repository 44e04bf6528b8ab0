"""CSV files with line breaks in quoted fields, read by many tasks each.

Where a file is split, it isn't known whether the next line starts a row or goes on inside quotes. One pass over the
lines finds, for each split, what it ends in from either start: a function of one bit to one bit. These functions
applied one after the other, from the start of the file, tell every split its start. The second pass then puts lines
together to rows inside each split. A row that runs across splits comes as fragments, which a small aggregate joins.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINES = "value string, file long, start long, length long"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the end of a line lies inside quotes. Quotes open a field only at its start; a doubled one stands for
    itself; what follows a closing quote belongs to the field up to the next comma."""
    at = 0
    while True:
        if inside or line[at : at + 1] == '"':
            at += not inside
            while True:
                at = line.find('"', at)
                if at < 0:
                    return True
                if line[at + 1 : at + 2] != '"':
                    break
                at += 2
            inside = False
            at += 1
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines as they stand in the splits of files: what a split begins with is the whole line after its offset."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(files).select(
        "value",
        F.xxhash64(meta["file_path"]).alias("file"),
        meta["file_block_start"].alias("start"),
        meta["file_block_length"].alias("length"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, int], pa.Array]]:
    """The values of a batch, split by split; the lines of a split stand together."""
    keys = list(zip(*(batch[c].to_numpy().tolist() for c in ("file", "start", "length")), strict=True))
    begin = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[begin]:
            yield keys[begin], batch["value"].slice(begin, i - begin)
            begin = i


def _quoted(values: pa.Array) -> list[int]:
    """The lines that hold a quote: only they change the state."""
    return pc.indices_nonzero(pc.match_substring(values, '"')).to_pylist()


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, length, from_outside, from_inside, left): what a split ends in, and whether it comes to the end of
    a row if it starts inside quotes."""
    found: dict[tuple[int, int, int], list[bool]] = {}
    for batch in batches:
        for key, values in _runs(batch):
            state = found.setdefault(key, [False, True, False])
            for i in _quoted(values):
                line = values[i].as_py()
                state[0], state[1] = ends_inside(line, state[0]), ends_inside(line, state[1])
                state[2] |= not state[1]
    rows = [(*key, *state) for key, state in found.items()]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    types = [pa.int64()] * 3 + [pa.bool_()] * 3
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        ["file", "start", "length", "from_outside", "from_inside", "left"],
    )


@dataclass(frozen=True)
class Start:
    """How a split starts, and whether it ends inside quotes. ``owner`` is the split in which the row begins that the
    first lines go on with."""

    inside: bool
    owner: int
    open: bool


def split_starts(functions: list) -> dict[tuple[int, int, int], Start]:
    """Of all splits, from the function of each."""
    starts: dict[tuple[int, int, int], Start] = {}
    by_file = defaultdict(list)
    for r in functions:
        by_file[r.file].append(r)
    for file, splits in by_file.items():
        inside, owner = False, -1
        for r in sorted(splits, key=lambda r: r.start):
            after = r.from_inside if inside else r.from_outside
            starts[file, r.start, r.length] = Start(inside, owner, after)
            if not inside or r.left:
                owner = r.start
            inside = after
    return starts


def _rows(starts: dict[tuple[int, int, int], Start], paths: dict[int, str], windows: set[int], fragments: bool):
    """(path, owner, start, row): the rows that begin and end in a split, or the fragments of those that don't; not the
    header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, open_lines, head, header = None, None, [], False, False
        out: list[tuple[str, int, int, str]] = []

        def flush(whole: bool) -> None:
            """A row has ended, or its split has."""
            nonlocal open_lines, head, header
            text = "\n".join(open_lines)
            if key[0] in windows:
                text = text.replace("\r\n", "\n").removesuffix("\r")
            if header and text:
                if not whole and state.open:
                    raise ValueError(f"the header of {paths[key[0]]} does not end in its first split")
                open_lines, header = [], False
                return
            if head:
                piece = (paths[key[0]], state.owner, key[1], text)
            else:
                piece = (paths[key[0]], key[1], key[1], text)
            if fragments == (head or not whole):
                out.append(piece)
            open_lines, head = [], False

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 4
            types = (pa.string(), pa.int64(), pa.int64(), pa.string())
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["path", "owner", "start", "row"]
            )

        inside = False
        for batch in batches:
            for own, values in _runs(batch):
                if own != key:
                    if open_lines:
                        flush(False)
                    if own not in starts:
                        raise RuntimeError("the files or the size of splits have changed since the CSV was opened")
                    key, state = own, starts[own]
                    inside = head = state.inside
                    header = key[1] == 0
                quoted = set(_quoted(values))
                for i, line in enumerate(values.to_pylist()):
                    if i in quoted:
                        inside = ends_inside(line, inside)
                    open_lines.append(line)
                    if not inside:
                        flush(True)
            yield batch_of()
        if open_lines:
            flush(False)
        yield batch_of()

    return run


def csv_rows(spark: SparkSession, files: dict[str, bool]) -> DataFrame:
    """(path, row): the rows of CSV files as text, but for the header of each, without the line break at their end.
    ``files`` has paths as ``_metadata.file_path`` gives them, and whether lines end at ``\\r\\n``, which a row then has
    as ``\\n``, or at ``\\n``.

    Takes one pass over the files now, for the state of each split; one row a split comes to the driver, which lists
    the splits of every scan anyway. An empty line is no row."""
    lines = _lines(spark, [unquote(f) for f in files])
    functions = lines.mapInArrow(_functions, "file long, start long, length long, from_outside boolean, from_inside boolean, left boolean")
    starts = split_starts(functions.collect())
    named = spark.createDataFrame([(f,) for f in files], "path string").select("path", F.xxhash64("path").alias("file")).collect()
    paths = {r.file: r.path for r in named}
    if len(paths) < len(files):
        raise ValueError("two files have the same hash")
    windows = {number for number, path in paths.items() if files[path]}
    ddl = "path string, owner long, start long, row string"
    rows = lines.mapInArrow(_rows(starts, paths, windows, False), ddl).select("path", "row")
    # only splits that start or end inside quotes have fragments
    beside = [k[:2] for k, s in starts.items() if s.inside or s.open]
    if beside:
        there = F.struct("file", "start").isin(*[F.struct(F.lit(f).alias("file"), F.lit(s).alias("start")) for f, s in beside])
        pieces = lines.where(there).mapInArrow(_rows(starts, paths, windows, True), ddl)
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "row"))), lambda p: p["row"]), "\n")
        rows = rows.unionByName(pieces.groupBy("path", "owner").agg(joined.alias("row")).select("path", "row"))
    return rows.where("row != ''")
