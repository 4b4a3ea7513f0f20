"""Quoted CSV files cut into records by many tasks, against the reader that takes a file whole."""

import random

import pytest

from assayer.sources.csv import read_csv_text
from assayer.sources.quoted_csv import ends_inside, quoted_records

VALUES = [
    "", "x", "1.5", "a b", '"q"', '"a,b"', '"l1\nl2"', '"say ""yes"",\nthen ""no"""', '5" pipe', 'in " the middle',
    '"\n\n"', '"closed" tail', '""', '"""\n"', "é…", '"ü,\n""é"""', '"long ' + "line of text\n" * 12 + 'end"',
]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def whole(spark, path, encoding="UTF-8"):
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("encoding", encoding)
    return reader.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(str(path))


@pytest.mark.parametrize(("seed", "end", "encoding"), [(1, "\n", "UTF-8"), (2, "\r\n", "UTF-8"), (3, "\n", "ISO-8859-1")])
def test_random_records_equal_the_reader_of_whole_files(spark, rows, tmp_path, small_splits, seed, end, encoding):
    rng = random.Random(seed)
    values = [v for v in VALUES if encoding == "UTF-8" or "…" not in v]
    lines = ['id,"first\nhead",c']
    lines += [",".join([str(i), rng.choice(values), rng.choice(values)]) for i in range(120)]
    path = tmp_path / "q.csv"
    path.write_bytes(("\n".join(lines) + "\n").replace("\n", end).encode(encoding))
    found = read_csv_text(spark, str(path))
    assert quoted_records(spark, [str(path)], encoding) is not None
    assert found.columns == whole(spark, path, encoding).columns
    assert rows(found) == rows(whole(spark, path, encoding))
    assert len(rows(found)) == 120


def test_many_files_blank_lines_and_an_open_end(spark, rows, tmp_path, small_splits):
    (tmp_path / "a.csv").write_text('id,v\n1,"x\n' + "y\n" * 400 + 'z"\n\n2,b\n')
    (tmp_path / "b.csv").write_text('id,v\n3,"\n"\n\n4,"never closed\n5,c')
    found = rows(read_csv_text(spark, str(tmp_path)))
    assert found == [("1", "x\n" + "y\n" * 400 + "z"), ("2", "b"), ("3", "\n"), ("4", "never closed\n5,c")]


def test_carriage_returns_inside_lines_are_left_to_the_reader_of_whole_files(spark, rows, tmp_path):
    path = tmp_path / "mac.csv"
    path.write_bytes(b'id,v\r1,"a\rb"\r2,c\r')
    assert quoted_records(spark, [str(path)], "UTF-8") is None
    assert rows(read_csv_text(spark, str(path))) == rows(whole(spark, path))


def test_records_with_too_many_fields_fail(spark, tmp_path, small_splits):
    path = tmp_path / "many.csv"
    path.write_text('id,v\n1,"a\nb"\n2,c,"d\ne"\n')
    with pytest.raises(Exception, match="more fields than the header"):
        read_csv_text(spark, str(path)).collect()


def test_header_only_and_a_single_record(spark, rows, tmp_path):
    (tmp_path / "h.csv").write_text('id,"a\nb"\n')
    assert rows(read_csv_text(spark, str(tmp_path / "h.csv"))) == []
    (tmp_path / "one.csv").write_text('id,v\n1,"a\nb"')
    assert rows(read_csv_text(spark, str(tmp_path / "one.csv"))) == [("1", "a\nb")]


@pytest.mark.parametrize(
    ("line", "outside", "inside"),
    [
        (b"a,b", False, True),
        (b'a,"b', True, False),
        (b'"', True, False),
        (b'""', False, True),
        (b'a,5" pipe', False, False),
        (b'end",x', False, False),
        (b'end","', True, True),
        (b'x"",y', False, True),
        (b'",5" pipe,"open', True, True),
    ],
)
def test_states_at_line_ends(line, outside, inside):
    assert (ends_inside(line, False), ends_inside(line, True)) == (outside, inside)
