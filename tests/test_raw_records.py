"""Delimited files: cells over line breaks in split files, and files that differ in their headers."""

import csv
import io
import random

import pytest
from pyspark.errors import PySparkException

from queixa.sources.raw import read_many, read_raw_csv


@pytest.fixture
def small_splits(spark):
    """Files are cut into pieces of a few lines."""
    keys = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def expected_rows(text, n):
    """What a reader of the whole text finds: too long records out, short ones padded, empty ones out."""
    found = list(csv.reader(io.StringIO(text, newline=""), delimiter=";"))[1:]
    return [[*r, *[""] * (n - len(r))] for r in found if len(r) <= n and any(c.strip() for c in r) or len(r) in range(2, n + 1)]


def rows_of(df):
    return [["" if c is None else c for c in r] for r in df.collect()]


def cell(rng):
    kind = rng.random()
    plain = "".join(rng.choice("abç ") for _ in range(rng.randrange(1, 6)))
    if kind < 0.45:
        return plain
    if kind < 0.6:
        return plain + '"' + plain  # a quote inside a cell that is not quoted
    inner = "".join(rng.choice(["x", ";", '""', "\n", "\n\n", "é", " "]) for _ in range(rng.randrange(0, 9)))
    return f'"q{inner}q"'


@pytest.mark.parametrize("seed", range(12))
def test_random_files_in_many_splits(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    lines = ["A;B;C"] + [";".join(cell(rng) for _ in range(rng.choice([1, 2, 3, 3, 3, 3, 4]))) for _ in range(rng.choice([5, 60]))]
    text = "\n".join(lines) + "\n"
    path = tmp_path / "dados.csv"
    path.write_bytes(text.encode("latin-1"))
    assert spark.read.text(str(path)).rdd.getNumPartitions() >= len(text.encode("latin-1")) // 150
    df = read_raw_csv(spark, str(path))
    assert df.columns == ["A", "B", "C"]
    expected = [r for r in expected_rows(text, 3)]
    assert sorted(rows_of(df)) == sorted(expected)


def test_a_cell_longer_than_several_splits(spark, tmp_path, small_splits):
    long_cell = "\n".join(f"linha {i}; ainda" for i in range(200))
    path = tmp_path / "dados.csv"
    path.write_text(f'A;B\n1;antes\n2;"{long_cell}"\n3;"a\nb"\n4;depois\n')
    got = dict(tuple(r) for r in read_raw_csv(spark, str(path)).collect())
    assert got == {"1": "antes", "2": long_cell, "3": "a\nb", "4": "depois"}


def test_long_quoted_cells_without_breaks(spark, tmp_path):
    path = tmp_path / "dados.csv"
    path.write_text('A;B\n1;"' + "x;" * 100_000 + '"\n2;"' + 'a""' * 50_000 + '\nfim"\n')
    got = dict(tuple(r) for r in read_raw_csv(spark, str(path)).select("A", "B").collect())
    assert len(got["1"]) == 200_000 and got["2"] == 'a"' * 50_000 + "\nfim"


@pytest.mark.parametrize("text", ['A;B\n1;"sem fim\n2;x\n3;y\n', 'A;B\n1;"ok\nok"\n2;"' + "linha\n" * 400 + '"\n'])
def test_cells_never_closed_are_an_error(spark, tmp_path, text):
    path = tmp_path / "dados.csv"
    path.write_text(text)
    with pytest.raises(PySparkException, match="not closed"):
        read_raw_csv(spark, str(path), most_record_bytes=2000).collect()


def test_breaks_may_be_left_alone(spark, tmp_path):
    path = tmp_path / "dados.csv"
    path.write_text('A;B\n1;"duas\nlinhas"\n')
    assert read_raw_csv(spark, str(path), multi_line=False).count() == 2


def test_files_of_a_folder_may_differ_in_their_headers(spark, tmp_path, small_splits):
    folder = tmp_path / "pasta com espaço"
    folder.mkdir()
    (folder / "1.csv").write_text("A;B\n" + "".join(f"a{i};b{i}\n" for i in range(40)))
    (folder / "2.csv").write_text("B;A\n" + "".join(f"b{i};a{i}\n" for i in range(40, 80)))
    (folder / "3.csv").write_text('A;B;C\na80;"b\n80";c\na81;b81;c;longa demais\n')
    (folder / "4.csv").write_text("A;B\na82\n")
    (folder / "5.csv").write_text("")
    df = read_raw_csv(spark, str(folder))
    assert df.columns == ["A", "B", "C"]
    expected = [[f"a{i}", f"b{i}", ""] for i in range(80)] + [["a80", "b\n80", "c"], ["a82", "", ""]]
    assert sorted(rows_of(df)) == sorted(expected)
    assert sum(f.count() for f in read_many(spark, [str(folder), str(tmp_path / "nada")])) == 82


def test_no_header_at_all(spark, tmp_path):
    (tmp_path / "vazio.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_raw_csv(spark, str(tmp_path / "vazio.csv"))
