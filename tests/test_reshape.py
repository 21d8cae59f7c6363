import pytest

from conftest import rows
from mapweave.operators import reshape


def test_checkbox_groups():
    columns = ["id", "a___1", "b___x", "a___2", "c__d", "a___1___z", "___e"]
    assert reshape.checkbox_groups(columns) == {
        "a": ["a___1", "a___2", "a___1___z"],
        "b": ["b___x"],
        "": ["___e"],
    }
    assert reshape.plain_columns(columns) == ["id", "c__d"]


def test_ticks(spark):
    df = spark.createDataFrame(
        [(1, "1", 1), (2, "0", 1), (3, "", None), (4, None, 0), (1, "1", 1), (5, "11", 11)],
        "id int, f___a string, f___b int",
    )
    got = reshape.unpivot_ticks(df, [("id", "key")], ["f___a", "f___b"], "f")
    assert got.columns == ["key", "f"]
    assert rows(got) == [(1, "f___a"), (1, "f___b"), (2, "f___b")]


def test_ticks_are_a_bag(spark):
    df = spark.createDataFrame([(1, "1", "0"), (1, "1", ""), (1, "1", "0")], "id int, f___a string, f___b string")
    got = reshape.unpivot_ticks(df, [("id", "id")], ["f___a", "f___b"], "f")
    assert rows(got) == [(1, "f___a"), (1, "f___a")]


def test_key_named_like_a_flag(spark):
    df = spark.createDataFrame([(1, "1")], "id int, f___a string")
    assert rows(reshape.unpivot_ticks(df, [("id", "f___a")], ["f___a"], "value")) == [(1, "f___a")]


@pytest.mark.parametrize("large", [False, True])
def test_copied_columns_are_attached(spark, request, large):
    if large:
        request.getfixturevalue("small_limits")
    ticks = spark.createDataFrame([(1, "f___a"), (1, "f___b"), (None, "f___a"), (3, "f___a")], "key int, f string")
    copied = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3), ("w", 3), ("v", None)], "label string, key int")
    got = reshape.attach_copied(ticks, copied, ["key"])
    assert got.columns == ["key", "f", "label"]
    assert rows(got) == [
        (1, "f___a", "x"), (1, "f___b", "x"), (3, "f___a", "w"), (3, "f___a", "z"),
    ]


def test_prefixed_to_long(spark):
    df = spark.createDataFrame(
        [("Ann", "", 1), ("Ann", None, 2), ("Bob", "Ann", 3)],
        "reviewer_name_x string, reviewer_name_y_z string, id int",
    )
    got = reshape.prefixed_to_long(df, "reviewer_name_", "reviewer", "organization")
    assert rows(got) == [("Ann", "x"), ("Ann", "y_z"), ("Bob", "x")]
    assert reshape.prefixed_to_long(df, "nothing_", "reviewer", "organization") is None
