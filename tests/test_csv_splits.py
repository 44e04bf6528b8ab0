"""Large CSV files read by many tasks, and the headers of many files."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from touchline.sources import files as source
from touchline.sources.csv_splits import csv_rows, ends_inside, split_starts
from touchline.sources.files import column_names, malformed_csv_rows, read_csv

DDL = "n BIGINT, a STRING, b STRING"


@pytest.mark.parametrize(
    "line, outside, inside",
    [
        ("", False, True),
        ("a,b", False, True),
        ('"a",b', False, False),  # from inside, the first quote closes, and a quote in a bare field opens nothing
        ('"a', True, False),
        ('a,"b', True, False),
        ('a"b', False, False),
        ('a "b', False, False),
        ('"a""b', True, False),
        ('"a"""', False, False),
        ('"a""', True, False),
        ('""', False, True),
        ('","', False, True),
        ('x"', False, False),
        ('x","y', True, True),
        ('"a"\r', False, False),
        ('"a"b,"c', True, True),
    ],
)
def test_ends_of_lines(line, outside, inside):
    assert ends_inside(line, False) is outside
    assert ends_inside(line, True) is inside


def random_file(rnd, rows, odd=0.3, newline="\n"):
    """Rows with quotes, commas and line breaks inside quotes, some of them longer than a split."""
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=newline)
    writer.writerow(["b", "n", "a"])
    pieces = ["x", "y z", '"', '""', ",", "\n", "\n\n", "'", "é", "a" * 40, '",', '\n"', "\r\n" if newline == "\r\n" else "\n,"]
    for i in range(rows):
        make = lambda: "".join(rnd.choice(pieces) for _ in range(rnd.randrange(6))) if rnd.random() < odd else "plain"
        long = "l\n" * rnd.randrange(2000) if rnd.random() < 0.01 else make()
        writer.writerow([make(), i, long])
    return out.getvalue()


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed, odd, split", [(1, 0.3, 700), (2, 0.9, 300), (3, 0.02, 5000), (4, 0.0, 1000)])
def test_splits_give_the_rows_of_one_task(spark, conf, tmp_path, monkeypatch, seed, odd, split):
    rnd = random.Random(seed)
    folder = tmp_path / "a folder"
    folder.mkdir()
    for k, size in enumerate((400, 1, 0, 50)):
        text = random_file(rnd, size, odd)
        (folder / f"part {k}.csv").write_bytes((text if k else text.rstrip("\n")).encode())
    whole = found(read_csv(spark, str(folder), DDL))
    monkeypatch.setattr(source, "LARGE", 0)
    conf(**{"spark__sql__files__maxPartitionBytes": str(split), "spark__sql__files__openCostInBytes": "1"})
    df = read_csv(spark, str(folder), DDL)
    assert found(df) == whole and len(whole) >= 400
    assert df.rdd.getNumPartitions() > 5
    # one column is read as all are
    assert found(df.select("n")) == sorted(((r[0],) for r in whole), key=repr)
    assert malformed_csv_rows(spark, str(folder), DDL).count() == 0


def test_windows_line_ends(spark, conf, tmp_path, monkeypatch):
    (tmp_path / "x.csv").write_bytes(random_file(random.Random(5), 300, 0.2, "\r\n").encode())
    whole = found(read_csv(spark, str(tmp_path), DDL))
    monkeypatch.setattr(source, "LARGE", 0)
    conf(**{"spark__sql__files__maxPartitionBytes": "900", "spark__sql__files__openCostInBytes": "1"})
    assert found(read_csv(spark, str(tmp_path), DDL)) == whole and len(whole) == 300


def test_a_row_across_many_splits(spark, conf, tmp_path):
    long = "\n".join(f"line {i}, no quote" for i in range(300))
    (tmp_path / "x.csv").write_text(f'n,a,b\n1,"{long}",e\n2,"{long}\n""",f\n')
    conf(**{"spark__sql__files__maxPartitionBytes": "200", "spark__sql__files__openCostInBytes": "1"})
    path = spark.read.text(str(tmp_path / "x.csv")).select("_metadata.file_path").first()[0]
    rows = sorted(r.row for r in csv_rows(spark, {path: False}).collect())
    assert rows == [f'1,"{long}",e', f'2,"{long}\n""",f']


def test_malformed_rows_of_large_files(spark, conf, tmp_path, monkeypatch):
    (tmp_path / "x.csv").write_text('n,a,b\n1,"x\ny",z\n2,only two\n3,a,b,c\nno number,a,b\n4,"never closed\n,')
    for large in (1 << 30, 0):
        monkeypatch.setattr(source, "LARGE", large)
        conf(**{"spark__sql__files__maxPartitionBytes": "16", "spark__sql__files__openCostInBytes": "1"})
        bad = malformed_csv_rows(spark, str(tmp_path), DDL).collect()
        assert sorted(r.n for r in bad) == ["2", "3", "4", "no number"]
        assert all(r._path.endswith("x.csv") for r in bad)
        with pytest.raises(Exception, match="malformed row in .*x.csv"):
            read_csv(spark, str(tmp_path), DDL).collect()
        assert found(read_csv(spark, str(tmp_path), DDL, malformed="null").where("n = 1")) == [(1, "x\ny", "z")]


def test_other_splits_than_those_seen_stop_the_job(spark, conf, tmp_path, monkeypatch):
    (tmp_path / "x.csv").write_text("n,a,b\n" + '1,"a\nb",c\n' * 200)
    monkeypatch.setattr(source, "LARGE", 0)
    conf(**{"spark__sql__files__maxPartitionBytes": "100", "spark__sql__files__openCostInBytes": "1"})
    df = read_csv(spark, str(tmp_path), DDL)
    conf(**{"spark__sql__files__maxPartitionBytes": "200"})
    with pytest.raises(Exception, match="have changed"):
        df.collect()


def test_splits_follow_one_another():
    class Row:
        def __init__(self, start, out, inn, left):
            self.file, self.start, self.length, self.from_outside, self.from_inside, self.left = 1, start, 10, out, inn, left

    # opens; no quote at all; closes and opens; closes
    splits = [Row(30, False, False, True), Row(0, True, False, True), Row(10, False, True, False), Row(20, False, True, True)]
    starts = split_starts(splits)
    assert [(k[1], s.inside, s.owner, s.open) for k, s in sorted(starts.items())] == [
        (0, False, -1, True), (10, True, 0, True), (20, True, 0, True), (30, True, 20, False),
    ]


def test_headers_of_a_thousand_files_take_one_job(spark, tmp_path):
    for i in range(1000):
        names = ["n", "a", "b"] if i % 3 else ["b", f"other{i % 2}", "n", "a"]
        text = ",".join(f'"{c}"' for c in names) + "\n" + ",".join({"n": str(i)}.get(c, c) for c in names) + "\n"
        (tmp_path / f"{i:04d}.csv").write_text(text)
    context = spark.sparkContext
    context.setJobGroup("headers", "headers")
    df = read_csv(spark, str(tmp_path), DDL)
    jobs = context.statusTracker().getJobIdsForGroup("headers")
    context._jsc.clearJobGroup()
    # Spark lists many paths in jobs of its own, which have no stage of a query
    assert len([j for j in jobs if j is not None]) <= 1 + 3
    assert df.agg(F.count("n"), F.sum("n"), F.min("a"), F.max("b")).first() == (1000, 499500, "a", "b")


def test_header_names():
    assert column_names('a,"b,c",,A,"x\ny"') == ("a0", "b,c", "_c2", "A3", "x\ny")


def test_files_without_rows_and_without_header(spark, tmp_path):
    (tmp_path / "1.csv").write_text("n,a,b\n")
    (tmp_path / "2.csv").write_text("")
    assert read_csv(spark, str(tmp_path), DDL).count() == 0
    (tmp_path / "1.csv").write_text("\n")
    with pytest.raises(ValueError, match="no file with a header"):
        read_csv(spark, str(tmp_path), DDL)
