"""Parallel reading of quoted CSV against Python's csv module and Spark's one-task reader."""

import csv
import io
import random

import pytest

from reviewlab.sources import quoted_csv

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def tiny_splits(spark):
    """Scans cut files into splits of 64 bytes."""
    before = {k: spark.conf.get(k) for k in (SPLIT, "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    spark.conf.set(SPLIT, "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k in (SPLIT, "spark.sql.files.openCostInBytes"):
        spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def written(path, rows, newline="\n"):
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=newline)
    writer.writerow(["a", "b b", "c"])
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())


def read(spark, path):
    """Sorted rows; an empty field is null."""
    return sorted(tuple(v or "" for v in r) for r in quoted_csv.read_quoted_csv(spark, str(path)).collect())


def random_rows(seed, n):
    rng = random.Random(seed)
    bits = ["x", "é", ",", "\n", '"', '""', "\n\n", " ", "word " * 3, "\r\n", "漢", '",\n"', "line\n" * 30]
    return [(str(i), "".join(rng.choices(bits, k=rng.randint(0, 12))), rng.choice(["", "z", '"', "\n"])) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_across_splits(spark, tmp_path, tiny_splits, seed, newline):
    rows = random_rows(seed, 60)
    written(tmp_path / "reviews.csv", rows, newline)
    assert read(spark, tmp_path / "reviews.csv") == sorted(rows)
    assert quoted_csv.split_lines(spark, str(tmp_path / "reviews.csv")).rdd.getNumPartitions() > 8


def test_equals_the_one_task_reader(spark, tmp_path, tiny_splits):
    rows = [r for r in random_rows(9, 200)]
    written(tmp_path / "reviews.csv", rows)
    theirs = spark.read.option("header", True).options(**quoted_csv._OPTIONS).csv(str(tmp_path / "reviews.csv"))
    ours = quoted_csv.read_quoted_csv(spark, str(tmp_path / "reviews.csv"))
    assert ours.columns == theirs.columns
    assert sorted(map(tuple, ours.collect()), key=repr) == sorted(map(tuple, theirs.collect()), key=repr)


def test_a_break_at_every_place(spark, tmp_path, tiny_splits):
    """The same records, shifted by one byte at a time, so that splits end at quotes, breaks and letters."""
    folder = tmp_path / "many"
    folder.mkdir()
    body = '"a","b ""q""\n\nmore","' + "y" * 70 + '\nend"\n"c",d,\n\n"","",""\n'
    for shift in range(70):
        (folder / f"{shift}.csv").write_text(f'x,y,{"z" * (shift + 1)}\n{body}', encoding="utf-8")
    expected = [("a", 'b "q"\n\nmore', "y" * 70 + "\nend"), ("c", "d", None), (None, None, None)]
    found = quoted_csv.read_quoted_csv(spark, str(folder)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected * 70))


def test_odd_files(spark, tmp_path, tiny_splits):
    for name, content, rows in [
        ("header only", "a,b\n", []), ("no last break", 'a,b\n1,"2\n3"', [("1", "2\n3")]), ("open end", 'a,b\n1,2\n3,"4\n5\n', None),
        ("short and long", "a,b\n1\n1,2,3\n", [("1", ""), ("1", "2")]), ("quoted header", '"a\nx",b\n1,2\n', [("1", "2")]),
        ("long field", 'a,b\n1,"' + "word\n" * 2000 + '"\n3,4\n', [("1", "word\n" * 2000), ("3", "4")]),
    ]:
        path = tmp_path / f"{name}.csv"
        path.write_text(content, encoding="utf-8")
        found = read(spark, path)
        if rows is not None:
            assert found == rows, name
        else:
            assert found[0] == ("1", "2") and len(found) == 2
    assert quoted_csv.read_quoted_csv(spark, str(tmp_path / "quoted header.csv")).columns == ["a\nx", "b"]
