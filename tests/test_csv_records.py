"""CSV files read in splits against Spark's own reader and the writer."""

import random

import pytest

from conftest import rows
from mapweave.sources import readers, writers
from test_json_arrays import small_splits  # noqa: F401

BITS = ["a", "é", '"', '""', ",", "\n", "\r\n", "\\", "\\\"", " ", "x y", '",', '"\n"', "漢"]


def some_cell(draw):
    return draw.choice([None, "plain", "".join(draw.choice(BITS) for _ in range(draw.randint(1, 6)))])


def some_rows(draw, count):
    return [(f"k{i}", some_cell(draw), some_cell(draw)) for i in range(count)]


@pytest.mark.parametrize("seed", range(4))
def test_what_is_written_is_read(spark, tmp_path, small_splits, seed):  # noqa: F811
    data = some_rows(random.Random(seed), 90)
    df = spark.createDataFrame(data, "k string, `a b` string, c string")
    writers.write_csv(df.repartition(2), str(tmp_path / "out"))
    for split_bytes in (0, 1 << 30):
        got = readers.read_csv(spark, str(tmp_path / "out"), split_bytes=split_bytes)
        assert got.columns == df.columns
        # The writer strips blanks and line breaks around a cell.
        assert set(map(tuple, got.collect())) == {tuple(c and (c.strip() or None) for c in row) for row in data}
        assert got.count() == len(data)


# A quote inside an unquoted cell is an ordinary character.
PLAIN = 'k,v\n1,5" pipe\n2,"a\nb"\n\n3,x"y"z\n4,"q"tail\n5,"""x"""\n6,""\n7,"two\n\nblank"\n8,6" and 7"\n'


@pytest.mark.parametrize("text", [PLAIN, PLAIN.replace("\n", "\r\n"), PLAIN.rstrip("\n"), "k,v\n", '"k\n2",v\n1,2\n', "k,v\n1,\\\n2,\"\\\"\n"])
def test_lines_and_quotes_are_those_of_the_one_task_reader(spark, tmp_path, small_splits, text):  # noqa: F811
    spark.conf.set("spark.sql.files.maxPartitionBytes", "23")
    path = tmp_path / "list.csv"
    path.write_bytes(text.encode())
    expected = readers.read_csv(spark, str(path))
    got = readers.read_csv(spark, str(path), split_bytes=0)
    assert got.columns == expected.columns and rows(got) == rows(expected)


def test_large_and_small_parts_of_a_list(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n" + "".join(f'{i},"x\n{i}"\n' for i in range(50)))
    (tmp_path / "b.csv").write_text('k,v\n50,"y, ""z"""\n')
    got = rows(readers.read_csv(spark, str(tmp_path), split_bytes=100))
    assert len(got) == 51 and ("7", "x\n7") in got and ("50", 'y, "z"') in got


@pytest.mark.parametrize("text", ["k,v\n1,2,3\n", "k,v\n1\n", 'k,v\n1,"open\n2,3\n'])
def test_broken_lists_are_errors(spark, tmp_path, text):
    (tmp_path / "list.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv(spark, str(tmp_path / "list.csv"), split_bytes=0).collect()
