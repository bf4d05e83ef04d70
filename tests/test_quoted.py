"""Quoted line breaks across byte ranges, against Spark's own reader of whole files."""

import csv
import random

import pytest
from helpers import dicts
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from wageledger.sources import quoted
from wageledger.sources.landing import read_landed, read_snapshot

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "abcd"])
CELLS = ["x", "", "é,ü", "line\nbreak", '"', '""', 'a "quoted" word', '\n"\n', "a\n\n\nb", "long " * 30, " pad ", "1,2", "\n"]


def write(path, rows, end="\n"):
    with path.open("w", encoding="utf-8", newline="") as f:
        csv.writer(f, lineterminator=end).writerows([list("abcd"), *rows])


@pytest.fixture
def ranges(spark):
    """Byte ranges of a few lines each."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(3))
def test_equals_the_reader_of_whole_files(spark, tmp_path, ranges, seed, end):
    rng = random.Random(seed)
    for i in range(3):
        write(tmp_path / f"f{i}.csv", [[rng.choice(CELLS) for _ in "abcd"] for _ in range(rng.choice([0, 1, 120]))], end)
    got = quoted.read_quoted(spark, str(tmp_path), SCHEMA)
    want = read_landed(spark, str(tmp_path), SCHEMA, multiline=True)
    assert got.columns == want.columns
    assert dicts(got) == dicts(want)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, ranges):
    write(tmp_path / "f.csv", [["a\nb", str(i), "x" * 50, '"\n"'] for i in range(400)])
    text = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert text.rdd.getNumPartitions() > 20
    assert quoted.read_quoted(spark, str(tmp_path), SCHEMA).count() == 400


def test_a_record_over_many_ranges(spark, tmp_path, ranges):
    body = "\n".join(f"line {i}" for i in range(2000))
    write(tmp_path / "f.csv", [["1", body, "", ""], ["2", "short", "", ""]])
    rows = {r["a"]: r["b"] for r in quoted.read_quoted(spark, str(tmp_path), SCHEMA).collect()}
    assert rows == {"1": body, "2": "short"}


def test_missing_quotes_fail(spark, tmp_path, monkeypatch):
    (tmp_path / "odd.csv").write_text('a,b,c,d\n1,"2,3,4\n5,6,7,8\n', encoding="utf-8")
    with pytest.raises(ValueError, match="quotes do not match in .*odd.csv"):
        quoted.read_quoted(spark, str(tmp_path), SCHEMA)
    (tmp_path / "odd.csv").write_text('a,b,c,d\n1,"2,3,4\n5,6,7,8\n9,"0,0,0\n', encoding="utf-8")
    monkeypatch.setattr(quoted, "MAX_LINES", 2)
    with pytest.raises(ValueError, match="a record of 3 lines"):
        quoted.read_quoted(spark, str(tmp_path), SCHEMA)


def test_short_records_fail(spark, tmp_path):
    (tmp_path / "short.csv").write_text('a,b,c,d\n1,"2\n2"\n', encoding="utf-8")
    with pytest.raises((PySparkException, Py4JJavaError)):
        quoted.read_quoted(spark, str(tmp_path), SCHEMA).collect()


def test_snapshot_takes_names_from_the_header(spark, tmp_path, ranges):
    rng = random.Random(5)
    write(tmp_path / "s.csv", [[rng.choice(CELLS) for _ in "abcd"] for _ in range(80)])
    text = (tmp_path / "s.csv").read_text(encoding="utf-8")
    (tmp_path / "s.csv").write_text(text.replace("a,b,c,d", '"the ""a""",b,"c\nc",d', 1), encoding="utf-8")
    got, want = quoted.read_quoted_snapshot(spark, str(tmp_path / "s.csv")), read_snapshot(spark, str(tmp_path / "s.csv"), multiline=True)
    assert got.columns == want.columns == ['the "a"', "b", "c\nc", "d"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
