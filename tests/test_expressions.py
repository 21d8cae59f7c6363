import pytest
from pyspark.sql import functions as F

from conftest import rows
from mapweave.plans.rules import Rule, node, project_rules, rule_column

SCHEMA = "a string, b string, n int, m int, d date, t boolean"


@pytest.fixture(scope="module")
def data(spark):
    values = [
        ("x", "y", 1, 2, "2020-01-02", True),
        ("", "y", None, 2, "2020-01-02", False),
        (None, "", 3, None, None, None),
    ]
    df = spark.createDataFrame(values, "a string, b string, n int, m int, d string, t boolean")
    return df.withColumn("d", F.col("d").cast("date"))


def evaluate(df, kind, *args, reads=()):
    rule = Rule("t", "v", kind, args, reads=reads)
    return [r[0] for r in df.select(rule_column(rule, df.schema)).collect()]


def test_field_and_literal(data):
    assert evaluate(data, "field", "a") == ["x", "", None]
    assert evaluate(data, "literal", '"k"') == ["k"] * 3


def test_first_nonblank(data):
    assert evaluate(data, "first_nonblank", "a", "b") == ["x", "y", ""]
    assert evaluate(data, "first_nonblank", "a", "b", '"z"') == ["x", "y", "z"]
    assert evaluate(data, "first_nonblank", "n", "m") == [1, 2, 3]


def test_first_nonblank_of_mixed_types_is_text(data):
    assert evaluate(data, "first_nonblank", "n", "b") == ["1", "y", "3"]
    assert evaluate(data, "first_nonblank", "d", '"never"')[2] == "never"


def test_if_equal(data):
    assert evaluate(data, "if_equal", "a", '"x"', '"yes"', "b") == ["yes", "y", ""]
    # A null condition takes the other branch.
    assert evaluate(data, "if_equal", "a", '""', '"blank"', '"other"') == ["other", "blank", "other"]


def test_if_equal_across_types(data):
    assert evaluate(data, "if_equal", "n", '"1"', '"one"', '"no"') == ["one", "no", "no"]
    assert evaluate(data, "if_equal", '"bad"', "n", '"one"', '"no"') == ["no"] * 3
    assert evaluate(data, "if_equal", "t", '"yes"', '"on"', '"off"') == ["on", "off", "off"]
    assert evaluate(data, "if_equal", "d", '"2020-01-02"', '"d"', '"no"') == ["d", "d", "no"]
    assert evaluate(data, "if_equal", "d", '"2020-1-2"', '"d"', '"no"') == ["no"] * 3
    assert evaluate(data, "if_equal", "n", "m", "n", "m") == [2, 2, None]


def test_nested_operands(data):
    name = node("last_name", node("first_nonblank", '""', '"Mary Young"'))
    assert evaluate(data, "first_nonblank", '""', name) == ["Young"] * 3
    # Numbers stay numbers, and bad text next to one is no error.
    first = node("first_nonblank", "n", "n")
    assert evaluate(data, "first_nonblank", first, "n") == evaluate(data, "field", "n")
    assert evaluate(data, "if_equal", first, '"bad"', '"one"', '"no"') == ["no"] * 3
    assert evaluate(data, "if_equal", first, '"1"', node("literal", '"one"'), '"no"') == ["one", "no", "no"]


def test_free_sql(data):
    assert evaluate(data, "expr", "upper('x')", reads=("a",)) == ["X"] * 3


def test_generate_id_is_the_built_column(data):
    df = data.withColumn("v", F.lit(5).cast("long"))
    assert evaluate(df, "generate_id", "a") == [5, 5, 5]


def test_none_and_unknown_kinds_cannot_be_evaluated(data):
    with pytest.raises(ValueError, match="no value"):
        evaluate(data, "none")
    with pytest.raises(ValueError, match="unknown rule kind"):
        evaluate(data, "median", "n")


def test_projection_is_distinct(data):
    rules = [Rule("t", "k", "literal", ('"k"',)), Rule("t", "m", "field", ("m",))]
    assert rows(project_rules(data, rules)) == [("k", None), ("k", 2)]


def test_names_with_dots(spark):
    df = spark.createDataFrame([("v",)], "`a.b` string")
    assert evaluate(df, "field", "a.b") == ["v"]
