"""Multi-line CSV read in splits, against the read of whole files."""

import csv
import io
import random

import pytest
from pyspark.sql.types import StructType

from casegraph.sources import readers


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)


def random_file(seed, end="\n"):
    rng = random.Random(seed)
    pieces = ["a", "word", "\n", "\n\n", '"', '""', ",", " ", "é", "x" * 150, "line\nline", '",\n"']
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", "text", "last column"])
    for i in range(120):
        writer.writerow([i, "".join(rng.choices(pieces, k=rng.randrange(1, 9))) + ".", rng.choice(["z", "q,q"])])
        if rng.random() < 0.1:
            out.write(end)  # an empty line
    return out.getvalue()


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def in_one_task(spark, path):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equal_to_the_read_of_whole_files(spark, tmp_path, small_splits, end):
    for seed in range(2):
        folder = write(tmp_path / "data", f"f{seed}.csv", random_file(seed, end))
    got = readers.scan_records(spark, folder)
    assert got.columns == ["id", "text", "last column"]
    assert readers._lines(spark, folder).rdd.getNumPartitions() > 8
    want = [tuple(row) for seed in range(2) for row in csv.reader(io.StringIO(random_file(seed, end), newline="")) if row and row[0] != "id"]
    assert rows_of(got) == sorted(want)
    if end == "\n":
        assert rows_of(got) == rows_of(in_one_task(spark, folder))


def test_a_cell_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i} "" of the note' for i in range(400))
    path = write(tmp_path / "d", "n.csv", f'id,text\n1,"{long}"\n2,short\n3,"{long}"')
    want = long.replace('""', '"')
    assert rows_of(readers.scan_records(spark, path)) == [("1", want), ("2", "short"), ("3", want)]


def test_nulls_empty_cells_and_odd_names(spark, tmp_path, small_splits):
    path = write(tmp_path / "d", "n.csv", 'id,a`b,_broken\n1,,""\n\n2," x ",\n2," x ",\n')
    got = readers.scan_records(spark, path)
    assert got.columns == ["id", "a`b", "_broken"]
    assert sorted(map(str, map(tuple, got.collect()))) == ["('1', None, None)", "('2', ' x ', None)", "('2', ' x ', None)"]
    assert got.subtract(in_one_task(spark, path)).count() == 0  # a quoted empty cell is null there, too
    empty = write(tmp_path / "e", "n.csv", "id,text\n")
    assert readers.scan_records(spark, empty).count() == 0
    typed = readers.scan_csv(spark, empty, StructType.fromDDL("text string, id long"), multi_line=True)
    assert typed.collect() == [] and typed.columns == ["text", "id"]


def test_broken_files_are_errors(spark, tmp_path, small_splits):
    unclosed = write(tmp_path / "u", "n.csv", 'id,text\n1,"never closed\n2,b\n')
    with pytest.raises(Exception, match="never closed in"):
        readers.scan_records(spark, unclosed).collect()
    short = write(tmp_path / "s", "n.csv", "id,text\n1,a\n2\n3,b\n")
    with pytest.raises(Exception, match="not as many cells"):
        readers.scan_records(spark, short).collect()
    assert sorted(r["id"] for r in readers.scan_records(spark, short, on_error="null").collect()) == ["1", "2", "3"]


def test_no_python_in_the_plan(spark, tmp_path):
    path = write(tmp_path / "d", "n.csv", "id,text\n1,a\n")
    plan = readers.scan_records(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and "Python" not in plan
