"""CSV texts with line ends, quotes and separators come back from a file that many tasks read."""

import csv
import random

import pytest

from bazaarlens.sources.split_csv import read_split_csv, records

TEXTS = ["plain", 'say "hi"', "a,b", "two\nlines", "crlf\r\nhere", '"', '""', '\n\n"\n', " padded ", "é🙂,\n\"x\"", "x" * 3000, "line\n" * 400, ",\n,", "null"]


@pytest.fixture
def small_parts(spark):
    small = {"spark.sql.files.maxPartitionBytes": "1500b", "spark.sql.files.openCostInBytes": "0"}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k in small:
        spark.conf.unset(k)


def write(path, rows, end="\n", header=("id", "text", "more")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        if header:
            out.writerow(header)
        out.writerows(rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_by_many_tasks(spark, tmp_path, small_parts, end):
    rng = random.Random(1)
    rows = [(i, rng.choice(TEXTS), rng.choice(TEXTS)) for i in range(600)]
    write(tmp_path / "a.csv", rows, end)
    lines = spark.read.text(str(tmp_path / "a.csv"))
    assert lines.rdd.getNumPartitions() > 50
    got = sorted(tuple(r) for r in read_split_csv(spark, str(tmp_path / "a.csv"), "id long, text string, more string").collect())
    assert got == rows


def test_several_files_and_no_header(spark, tmp_path, small_parts):
    rows = [(i, TEXTS[i % len(TEXTS)], "z") for i in range(100)]
    write(tmp_path / "a.csv", rows[:40], header=None)
    write(tmp_path / "b.csv", rows[40:], header=None)
    assert sorted(tuple(r) for r in read_split_csv(spark, str(tmp_path), "id long, text string, more string", header=False).collect()) == rows


def test_odd_files(spark, tmp_path):
    schema = "id long, text string"
    for name, content, want in [
        ("empty", "", []),
        ("header", "id,text\n", []),
        ("blank", "id,text\n\n1,a\n\r\n2,\n", [(1, "a"), (2, None)]),
        ("no_end", 'id,text\n1,"a\nb"', [(1, "a\nb")]),
        ("bad", "id,text\nx,a\n2\n", [(None, "a"), (2, None)]),
    ]:
        (tmp_path / name).write_bytes(content.encode())
        got = [tuple(r) for r in read_split_csv(spark, str(tmp_path / name), schema).collect()]
        assert sorted(got, key=str) == sorted(want, key=str), name


def test_an_open_quote_ends_with_its_file(spark, tmp_path, small_parts):
    (tmp_path / "a").write_text('1,"open\n' + "never closed\n" * 500)
    (tmp_path / "b").write_text("2,fine\n3,too\n")
    got = sorted(r.text for r in records(spark, str(tmp_path)).collect())
    assert len(got) == 3 and got[0].count("\n") == 500 and got[1:] == ["2,fine", "3,too"]
