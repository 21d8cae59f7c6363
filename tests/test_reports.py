from conftest import rows
from mapweave.operators import reports


def test_bag_difference(spark):
    left = [("a",), ("a",), ("a",), ("b",), (None,), (None,), ("d",)]
    right = [("a",), ("b",), ("b",), (None,), ("c",)]
    a, b = spark.createDataFrame(left, "x string"), spark.createDataFrame(right, "x string")
    assert rows(reports.bag_difference(a, b)) == [(None,), ("a",), ("a",), ("d",)]
    assert rows(reports.set_difference(a, b)) == [("d",)]


def test_counted(spark):
    df, observation = reports.counted(spark.range(12), "twelve")
    df.write.format("noop").mode("overwrite").save()
    assert observation.get["rows"] == 12
