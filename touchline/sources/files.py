"""Reading raw and staged tables, writing staged tables."""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import RAW, STAGED
from touchline.sources.csv_splits import csv_rows, ends_inside

# The quoting of the CSV files (a quote inside a field is doubled).
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
CORRUPT = "_corrupt_record"
#: Bytes of a file with line breaks in quotes that one task reads, and of one that is read to its end for its header.
LARGE, SMALL = 64 << 20, 1 << 20


def read_csv(spark: SparkSession, path: str, ddl: str, multi_line: bool = True, malformed: str = "fail") -> DataFrame:
    """Read a headered CSV file or folder. Columns are found by their header name, wherever they stand in each
    file and whatever others there are, and cast to the given types. Nothing is inferred: the work at this point is one
    job that reads the header of every file, and one more pass over large files with ``multi_line``. A file without any
    line has no rows.

    A row with more or fewer fields than its header, or with a value that does not fit its type, stops the job with
    its path; with ``malformed="null"`` such a value, and every field that is not there, is null.
    ``malformed_csv_rows`` lists those rows. An empty field is null and fits any type.

    Quoted fields may hold line breaks. A file of up to ``LARGE`` bytes is then read by one task; a larger one by many,
    after a pass that finds out which of its splits start inside quotes (``csv_splits``). Without any such line break
    files can be read in one pass with ``multi_line=False``; a row that ends inside a quoted field is then malformed.
    """
    if malformed not in ("fail", "null"):
        raise ValueError("malformed must be 'fail' or 'null'")
    schema = T.StructType.fromDDL(ddl)
    rows = _csv_rows(spark, path, schema, multi_line)
    if malformed == "null":
        return rows.select(*(_typed(f).alias(f.name) for f in schema))
    complaint = F.concat(F.lit("malformed row in "), F.col("_path"))
    # each value carries the check, so that a plan that reads one column makes it too
    return rows.select(*(F.when(_is_malformed(schema), F.raise_error(complaint)).otherwise(_typed(f)).alias(f.name) for f in schema))


def malformed_csv_rows(spark: SparkSession, path: str, ddl: str, multi_line: bool = True) -> DataFrame:
    """The rows that ``read_csv`` does not accept: their path, and the wanted fields as text."""
    schema = T.StructType.fromDDL(ddl)
    return _csv_rows(spark, path, schema, multi_line).where(_is_malformed(schema)).select("_path", *(_field(f) for f in schema))


def _csv_rows(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """The wanted fields as text. Files with equal headers are one scan, with all columns of theirs."""
    headers: dict[tuple[str, ...], list] = {}
    for file in _headers(spark, path):
        headers.setdefault(column_names(file.header), []).append(file)
    scans = []
    for header, files in headers.items():
        stored = {c.lower() for c in header}
        if missing := [f.name for f in schema if f.name.lower() not in stored]:
            raise ValueError(f"{unquote(files[0].path)} has no column {', '.join(missing)}")
        fields = T.StructType([T.StructField(c, T.StringType()) for c in (*header, CORRUPT)])
        large = {f.path: f.windows for f in files if multi_line and f.size > LARGE}
        small = [unquote(f.path) for f in files if not multi_line or f.size <= LARGE]
        if small:
            rows = _csv_text(spark, small, multi_line, fields)
            scans.append(rows.select(*(_field(f) for f in schema), CORRUPT, F.input_file_name().alias("_path")))
        if large:
            options = {**CSV_OPTIONS, "multiLine": "true", "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE", "columnPruning": "false"}
            # from_csv takes its schema as text, in which any name may stand between backquotes
            parsed = F.from_csv("row", ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in fields), options)
            rows = csv_rows(spark, large).select("path", parsed.alias("fields")).select("path", "fields.*")
            scans.append(rows.select(*(_field(f) for f in schema), CORRUPT, F.col("path").alias("_path")))
    if not scans:
        raise ValueError(f"no file with a header in {path}")
    return reduce(DataFrame.unionByName, scans)


# More than any file holds, so that each is one split of its own.
ONE_SPLIT = str(1 << 50)


def _headers(spark: SparkSession, path: str) -> list:
    """(path, size, header, windows) of all files, in one job of a task for each. The task stops after the header, where
    that is worth it. ``windows``: lines end in two characters."""
    meta = F.col("_metadata")
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    lines = lines.select("value", meta["file_path"].alias("path"), meta["file_size"].alias("size"))
    settings = {"spark.sql.files.maxPartitionBytes": ONE_SPLIT, "spark.sql.files.openCostInBytes": ONE_SPLIT}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        return lines.mapInArrow(_first_row, "path string, size long, header string, windows boolean").collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row, inside, done, windows = [], False, False, False
    for batch in batches:
        if done:  # the rest of a small file
            continue
        for value in batch["value"]:
            line = value.as_py() if row else value.as_py().removeprefix("\ufeff")
            windows |= not row and line.endswith("\r")
            inside = ends_inside(line, inside)
            row.append(line)
            if inside:
                continue
            if header := "\n".join(row).removesuffix("\r"):
                columns = [*(batch[c].slice(0, 1) for c in ("path", "size")), pa.array([header], pa.string()), pa.array([windows])]
                yield pa.RecordBatch.from_arrays(columns, ["path", "size", "header", "windows"])
                done = True
                break
            row = []
        # a worker that leaves its input unread ends, which costs more than a small file does
        if done and batch["size"][0].as_py() > SMALL:
            return


def column_names(header: str) -> tuple[str, ...]:
    """The names of a header row: a number for one that is empty, and after those that differ in case only or not at
    all. This is how the CSV reader of Spark names them."""
    cells = next(csv.reader(io.StringIO(header, newline="")))
    known = Counter(c.lower() for c in cells)
    return tuple(f"_c{i}" if not c else f"{c}{i}" if known[c.lower()] > 1 else c for i, c in enumerate(cells))


def _csv_text(spark: SparkSession, files: list[str], multi_line: bool, schema: T.StructType) -> DataFrame:
    reader = spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower(), columnNameOfCorruptRecord=CORRUPT)
    # a parser that skips columns doesn't count the fields of a row
    reader = reader.options(mode="PERMISSIVE", columnPruning="false")
    return reader.schema(schema).csv(files)


def _field(field: T.StructField):
    return F.col(f"`{field.name}`").alias(field.name)


def _is_malformed(schema: T.StructType):
    """Told by the parser, or a value that is there and lost by its type."""
    lost = [F.col(f"`{f.name}`").isNotNull() & _typed(f).isNull() for f in schema if not isinstance(f.dataType, T.StringType)]
    return reduce(lambda x, y: x | y, lost, F.col(CORRUPT).isNotNull())


def _typed(field: T.StructField):
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return column
    if isinstance(field.dataType, T.IntegralType):
        # ids next to missing values are often stored as 123.0; the decimal type keeps every digit
        return column.try_cast("decimal(38,6)").try_cast(field.dataType)
    return column.try_cast(field.dataType)


def read_raw(spark: SparkSession, directory: str, multi_line: bool = True, malformed: str = "fail") -> dict[str, DataFrame]:
    """The six raw tables by name."""
    return {name: read_csv(spark, f"{directory}/{name}.csv", ddl, multi_line, malformed) for name, ddl in RAW.items()}


def read_staged(spark: SparkSession, directory: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The staged tables by name, as ``write_tables`` or another program left them."""
    if fmt == "csv":
        return {name: read_csv(spark, f"{directory}/{name}.csv", ddl) for name, ddl in STAGED.items()}
    return {
        name: spark.read.format(fmt).schema(ddl).load(f"{directory}/{name}").select(*T.StructType.fromDDL(ddl).names)
        for name, ddl in STAGED.items()
    }


# Folders per league and season let a question about some of them skip the other files.
PARTITIONED = {"tabla_partidos": ["ID_liga", "Temporada"]}


# Order within and between the files of a table, so that a scan passes over ids and seasons that nobody asks for.
CLUSTERED = {
    "tabla_conformacion_plantel": ["ID_plantel", "ID_jugador"],
    "tabla_atributos_jugador": ["Temporada", "ID_jugador"],
    "tabla_goles": ["ID_Partido", "ID_Gol"],
}


def write_tables(
    tables: dict[str, DataFrame],
    directory: str,
    fmt: str = "parquet",
    partitioned: dict[str, list[str]] | None = None,
    clustered: dict[str, list[str]] | None = None,
) -> None:
    """Write each table to its own place under ``directory``, replacing what is there.

    A partitioned table is rebalanced by its folder columns before the write: each folder gets a few
    files of good size, and a folder with a large part of all rows is written by several tasks.

    A clustered table is cut into ranges of its columns, which are sorted; a ``Scope`` that is ``clustered`` makes use
    of that. Rows with equal columns lie in one file: the last ones tell the rows of a hot season or match apart.
    """
    partitioned = PARTITIONED if partitioned is None else partitioned
    clustered = CLUSTERED if clustered is None else clustered
    for name, df in tables.items():
        if fmt == "csv":
            df.write.mode("overwrite").options(**CSV_OPTIONS).csv(f"{directory}/{name}.csv")
            continue
        folders = partitioned.get(name, [])
        if folders:
            df = df.hint("rebalance", *folders)
        elif order := clustered.get(name):
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        df.write.mode("overwrite").format(fmt).partitionBy(*folders).save(f"{directory}/{name}")
