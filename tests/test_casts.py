from datetime import date

import pytest
from pyspark.sql import functions as F

from mapweave.functions.casts import cast_declared, comparable, declared_type


def cast_all(spark, texts, type_name):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    return [r[0] for r in df.select(cast_declared(F.col("x"), type_name)).collect()]


def test_int(spark):
    cases = {
        "1": 1, "-7": -7, "+3": 3, "1.5": 1, "-1.9": -1, "2.": 2, ".5": 0, "-.5": 0, ".": 0,
        " 4 ": 4, " 4.2 ": 4, "": None, "abc": None, "1.5x": None, "1e3": None, "--1": None,
        "99999999999": None, "+": None, "1.2.3": None, None: None,
    }
    assert cast_all(spark, cases, "int") == list(cases.values())


def test_boolean(spark):
    cases = {
        "yes": True, "y": True, "1": True, "true": True, "T": True,
        "no": False, "n": False, "0": False, "FALSE": False, "": None, "2": None, None: None,
        " Yes\t": True, "\n0 ": False, "tru": None, "y es": None,
    }
    assert cast_all(spark, cases, "boolean") == list(cases.values())


@pytest.mark.parametrize("kind", ["tinyint", "int", "bigint"])
def test_list_text_meets_whole_numbers_alike(spark, kind):
    cases = {"1": 1, "1.0": 1, " 7 ": 7, "x": None, "": None, "1e3": None}
    assert compared(spark, cases, kind) == list(cases.values())


def test_list_text_meets_fractions(spark):
    cases = {"1": 1.0, "1.5": 1.5, " .5 ": 0.5, "1e3": 1000.0, "x": None, "": None, "-2.": -2.0, "Infinity": float("inf")}
    assert compared(spark, cases, "double") == list(cases.values())


def compared(spark, texts, kind):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    other = spark.createDataFrame([], f"y {kind}").schema["y"].dataType
    return [r[0] for r in df.select(comparable(F.col("x"), other)).collect()]


def test_date(spark):
    cases = {
        "2020-01-02": date(2020, 1, 2), "2020-1-2": date(2020, 1, 2), "2020": date(2020, 1, 1),
        "2020-01-02T99": date(2020, 1, 2), "01/02/2020": None, "": None, "2020-13-01": None, None: None,
    }
    assert cast_all(spark, cases, "date") == list(cases.values())


def test_text_is_kept(spark):
    assert cast_all(spark, [" a ", "", None], "text") == [" a ", "", None]


@pytest.mark.parametrize("name", ["float", "", None])
def test_unsupported_type(name):
    with pytest.raises(ValueError, match="unsupported type"):
        declared_type(name)
