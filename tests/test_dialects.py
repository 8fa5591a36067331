"""Delimiter and quote of CSV files, found from all their records."""

import pytest

from tablesmith.sources.dialects import Dialect, identify
from tablesmith.sources.files import csv_scan, inline_rows, read_file

CASES = {
    "semicolon, decimal commas": ("a;b;c\n1,5;x;2\n2,5;y;3\n", Dialect(";"), [("1,5", "x", "2"), ("2,5", "y", "3")]),
    "tab": ("a\tb\n1\tx,y\n2\tz;w\n", Dialect("\t"), [("1", "x,y"), ("2", "z;w")]),
    "bar, single quotes": ("a|b|c\n1|'x|y'|2\n2|'it''s'|3\n", Dialect("|", "'"), [("1", "x|y", "2"), ("2", "it's", "3")]),
    "quoted delimiters": ('a;b\n1;"x;y;z"\n2;"p,q"\n', Dialect(";"), [("1", "x;y;z"), ("2", "p,q")]),
    "quoted line break": ('a;b\n1;"x;\ny"\n2;z\n', Dialect(";"), [("1", "x;\ny"), ("2", "z")]),
    "line break in single quotes": ("a,b\n1,'x\ny,z'\n2,'q'\n", Dialect(",", "'"), [("1", "x\ny,z"), ("2", "q")]),
    "apostrophes": ("a,b\n1,it's\n2,don't; no\n3,'tis\n", Dialect(","), [("1", "it's"), ("2", "don't; no"), ("3", "'tis")]),
    "one column": ("a\n1\n2\n", Dialect(","), [("1",), ("2",)]),
    "one column of text": ("text\nhello, you\nno; more\n", Dialect("\t"), [("hello, you",), ("no; more",)]),
    "tie: comma first": ("a,b;c\n1,2;3\n", Dialect(","), [("1", "2;3")]),
    "tie: more cells": ("a,b;c;d\n1,2;3;4\n", Dialect(";"), [("1,2", "3", "4")]),
    "CR LF": ('a;b\r\n1;"x;y"\r\n\r\n2;z\r\n', Dialect(";"), [("1", "x;y"), ("2", "z")]),
    "header only": ("a;b\n", Dialect(";"), []),
}


@pytest.mark.parametrize("case", CASES)
def test_layouts(spark, tmp_path, case):
    text, dialect, rows = CASES[case]
    (tmp_path / "f.csv").write_text(text, newline="")
    path = str(tmp_path)
    assert identify(spark, path) == dialect
    assert sorted(tuple(r) for r in csv_scan(spark, path, dialect=None).collect()) == sorted(rows)
    assert sorted(tuple(r) for r in csv_scan(spark, path, dialect=dialect, split=True).collect()) == sorted(rows)


def test_empty_file_and_malformed_rows(spark, tmp_path):
    (tmp_path / "f.csv").write_text("")
    assert identify(spark, str(tmp_path)) == Dialect()
    (tmp_path / "f.csv").write_text("a;b\n1;2\n3\n5;6\n")
    assert identify(spark, str(tmp_path)) == Dialect(";")
    with pytest.raises(Exception):          # the row is named, not taken for a file of one column
        csv_scan(spark, str(tmp_path), dialect=None).collect()


def test_the_whole_file_is_judged(spark, tmp_path):
    """The first thousand rows fit comma and semicolon; only what follows tells."""
    rows = ["a,b;c"] + [f"{i},x;y" for i in range(1000)] + [f"{i},p,q;r" for i in range(300)]
    (tmp_path / "f.csv").write_text("\n".join(rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        assert identify(spark, str(tmp_path)) == Dialect(";")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_imports_identify_unless_told(spark, tmp_path):
    (tmp_path / "f.csv").write_text("n;t\n1;a,b\n2;c\n")
    path = str(tmp_path)
    assert read_file(spark, path).dtypes == [("n", "int"), ("t", "string")]
    assert sorted(r["t"] for r in read_file(spark, path, schema="n int, t string").collect()) == ["a,b", "c"]
    assert sorted(map(tuple, read_file(spark, path, options={"sep": "\t"}).collect())) == [("1;a,b",), ("2;c",)]
    with pytest.raises(Exception):
        read_file(spark, path, auto_identify=False).collect()
    assert inline_rows(spark, "n|t\n1|x", work_dir=str(tmp_path / "in")).collect() == [(1, "x")]
