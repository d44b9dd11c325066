"""CSV source semantics (FIXTURES B1-B8)."""

import os

import pytest

from conftest import write
from loadstar.sources.csv import (EmptyCsvError, MalformedCsvError,
                                  read_csv, read_directory, splittable)


def rows(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda t: tuple("" if v is None else v for v in t))


def test_na_tokens_become_null(spark, tmp):
    p = write(os.path.join(tmp, "a.csv"),
              "a,b\n1,\n2,NA\n3,null\n4,None\n5,N/A\n6,NaN\n7,x\n")
    r = read_csv(spark, p)
    assert rows(r.data) == [("1", None), ("2", None), ("3", None),
                            ("4", None), ("5", None), ("6", None), ("7", "x")]


def test_long_row_quarantined_or_halts(spark, tmp):
    p = write(os.path.join(tmp, "a.csv"), "a,b\n1,2\n1,2,3\n")
    r = read_csv(spark, p)
    assert rows(r.data) == [("1", "2")]
    bad = r.malformed.collect()
    assert len(bad) == 1 and bad[0]["raw_record"] == "1,2,3"
    with pytest.raises(MalformedCsvError):
        read_csv(spark, p, on_error="halt")


def test_short_row_padded(spark, tmp):
    p = write(os.path.join(tmp, "a.csv"), "a,b\n1,2\n5\n")
    r = read_csv(spark, p, on_error="halt")
    assert rows(r.data) == [("1", "2"), ("5", None)]


def test_trailing_comma_is_long(spark, tmp):
    p = write(os.path.join(tmp, "a.csv"), "a,b\n1,2\n3,4,\n")
    r = read_csv(spark, p)
    assert rows(r.data) == [("1", "2")]
    assert r.malformed.count() == 1


def test_quoted_text(spark, tmp):
    p = write(os.path.join(tmp, "a.csv"),
              'a,b\n"p,q",2\n"x ""q"", y",2\n"m\nn",2\n')
    r = read_csv(spark, p, on_error="halt")
    assert sorted(r.data.toPandas()["a"].tolist()) == sorted(
        ["p,q", 'x "q", y', "m\nn"])


def test_header_only_and_empty(spark, tmp):
    p = write(os.path.join(tmp, "h.csv"), "a,b\n")
    assert read_csv(spark, p).data.count() == 0
    e = write(os.path.join(tmp, "e.csv"), "")
    with pytest.raises(EmptyCsvError):
        read_csv(spark, e)


def test_leading_zeros_kept(spark, tmp):
    p = write(os.path.join(tmp, "a.csv"), "id\n007\n008\n")
    assert rows(read_csv(spark, p).data) == [("007",), ("008",)]


def test_directory_groups_headers(spark, tmp):
    d = os.path.join(tmp, "in")
    os.makedirs(d)
    write(os.path.join(d, "1.csv"), "a,b\n1,2\n")
    write(os.path.join(d, "2.csv"), "b,c\n3,x\n")
    write(os.path.join(d, "3.csv"), "")
    write(os.path.join(d, "notes.txt"), "a,b\n9,9\n")
    r = read_directory(spark, d)
    assert sorted(r.data.columns) == ["a", "b", "c"]
    got = rows(r.data.select("a", "b", "c"))
    assert got == [(None, "3", "x"), ("1", "2", None)]
    assert len(r.skipped) == 1 and list(r.skipped)[0].endswith("3.csv")


def test_directory_without_valid_files(spark, tmp):
    d = os.path.join(tmp, "in")
    os.makedirs(d)
    write(os.path.join(d, "3.csv"), "")
    with pytest.raises(ValueError):
        read_directory(spark, d)


def test_missing_file_raises(spark, tmp):
    with pytest.raises(Exception):
        read_csv(spark, os.path.join(tmp, "nope.csv"))


def test_blank_lines_skipped_and_spaces_kept(spark, tmp):
    p = write(os.path.join(tmp, "a.csv"), "a,b\n1, 2 \n\n3,4\n")
    assert rows(read_csv(spark, p, on_error="halt").data) == [
        ("1", " 2 "), ("3", "4")]


def test_duplicate_header_renamed(spark, tmp, caplog):
    p = write(os.path.join(tmp, "a.csv"), "a,a,b\n1,2,3\n")
    r = read_csv(spark, p)
    assert r.columns == ["a", "a_1", "b"]
    assert rows(r.data) == [("1", "2", "3")]
    assert "Duplicate header names" in caplog.text


def test_single_line_mode_splits_large_files(spark, tmp):
    p = os.path.join(tmp, "big.csv")
    with open(p, "w") as f:
        f.write("a,b\n")
        for i in range(200000):
            f.write(f"{i},x{i}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        one = read_csv(spark, p, multi_line=True).data
        many = read_csv(spark, p, multi_line=False).data
        assert one.rdd.getNumPartitions() == 1
        assert many.rdd.getNumPartitions() > 1
        assert many.count() == one.count() == 200000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_auto_splits_only_files_without_quoted_line_breaks(spark, tmp):
    """Each file gives the rows of the multi-line reader; only those whose
    lines are whole records are read in splits."""
    body = "".join(f'{i},"x ""{i}"", y"\n' for i in range(20000))
    plain = {"lf.csv": "a,b\n" + body,
             "crlf.csv": ("a,b\n" + body).replace("\n", "\r\n"),
             "empty_lines.csv": "a,b\n\n" + body + "\n\n"}
    other = {"break.csv": "a,b\n" + body + '1,"m\nn"\n',
             # an even number of quotes on the line where the break is
             "even.csv": "a,b\n" + body + 'x"y,"m\nn"\n',
             "blank.csv": "a,b\n" + body + "  \n",
             "mixed.csv": "a,b\n" + body + "1,2\r\n3,4\n",
             "inner.csv": "a,b\n" + body + "1,2\r3,4\n"}
    paths = {n: write(os.path.join(tmp, n), t)
             for n, t in {**plain, **other}.items()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = splittable(spark, list(paths.values()))
        assert {os.path.basename(p) for p in got} == set(plain)
        for n, p in paths.items():
            auto = read_csv(spark, p).data
            whole = read_csv(spark, p, multi_line=True).data
            assert (auto.rdd.getNumPartitions() > 1) == (n in plain)
            assert rows(auto) == rows(whole), n
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    both = read_csv(spark, [paths["lf.csv"], paths["break.csv"]],
                    split_bytes=0, with_order=True)
    assert len(both.parts) == 2 and both.data.count() == 40001
    assert splittable(spark, list(paths.values())) == set()
    spaced = write(os.path.join(tmp, "a b%20ü.csv"), "a;b\n1;\"x;y\"\n")
    assert splittable(spark, [spaced], ";", 0) == {spaced}
    assert rows(read_csv(spark, spaced, delimiter=";", split_bytes=0).data) \
        == [("1", "x;y")]


def test_long_quoted_text_in_a_long_row(spark, tmp):
    p = write(os.path.join(tmp, "a.csv"),
              'a,b\n1,"' + "x," * 40000 + '",3\n')
    r = read_csv(spark, p, split_bytes=0)
    assert r.data.count() == 0 and r.malformed.count() == 1


@pytest.mark.parametrize("multi_line", [True, False, "auto"])
def test_long_rows_are_found_whatever_columns_are_read(spark, tmp, multi_line):
    p = write(os.path.join(tmp, "a.csv"), "a,b\n1,2\n1,2,3\n")
    r = read_csv(spark, p, multi_line=multi_line, split_bytes=0)
    assert r.data.count() == 1 and r.malformed.count() == 1
    assert rows(r.data.select("a")) == [("1",)]
    assert rows(r.data.select("b")) == [("2",)]
