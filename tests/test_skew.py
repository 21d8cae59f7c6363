import pytest
from pyspark.sql import functions as F

from conftest import rows
from mapweave.operators import skew


@pytest.fixture(scope="module")
def left(spark):
    """Two thirds of the rows share the key, or have none."""
    return spark.range(900).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("k"),
    )


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (7, "c"), (None, "d"), (99, "e")], "rk int, v string")


@pytest.fixture
def slices_of_20(monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_SLICE", 20)


@pytest.fixture
def counted(monkeypatch):
    """How often keys are counted."""
    calls, count = [], skew.heavy_keys
    monkeypatch.setattr(skew, "heavy_keys", lambda *args: calls.append(args) or count(*args))
    return calls


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("broadcast", [False, True])
def test_split_join_equals_plain_join(left, right, how, null_safe, broadcast, slices_of_20, monkeypatch):
    monkeypatch.setattr(skew, "will_broadcast", lambda df: broadcast)
    keys = [("k", "rk")]
    plain = left.join(right, skew.key_condition(keys, null_safe), how)
    split = skew.split_join(left, right, keys, how, null_safe)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_heavy_keys_on_both_sides(spark, left, how, null_safe, slices_of_20, counted):
    key = F.when(F.col("id") < 30, 1).when(F.col("id") < 60, 7)
    many = spark.range(95).select(key.alias("rk"), F.col("id").alias("v"))
    few = left.where("id < 200")
    plain = few.join(many, skew.key_condition([("k", "rk")], null_safe), how)
    split = skew.split_join(few, many, [("k", "rk")], how, null_safe)
    assert len(counted) == (1 if how == "left_anti" else 2)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def test_heavy_keys_are_spread_over_tasks(left, right, slices_of_20):
    heavy = skew.heavy_keys(left.select("k"), ["k"], "n")
    assert rows(heavy) == [(None, 15), (1, 16)]
    split = skew.split_join(left, right, [("k", "rk")], "left")
    assert "explode" in optimized(split)


def test_any_number_of_keys_can_be_heavy(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_SLICE", 2)
    df = spark.range(9000).select((F.col("id") % 3000).alias("k"))
    assert skew.heavy_keys(df, ["k"], "n").count() == 3000
    other = spark.range(3000).select(F.col("id").alias("rk"))
    assert skew.split_join(df, other, [("k", "rk")], "inner").count() == 9000


def test_equal_rows_go_to_many_slices(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_SLICE", 100)
    same = spark.range(5000).select(F.lit(1).alias("k"))
    heavy = skew.heavy_keys(same, ["k"], "n")
    sliced = skew._sliced(same, ["k"], heavy, "own", None, "other")
    counts = [r["count"] for r in sliced.groupBy("own").count().collect()]
    assert len(counts) == 50 and max(counts) <= 200


def test_small_left_side_with_a_hot_right_side(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_SLICE", 100)
    monkeypatch.setattr(skew, "will_broadcast", lambda df: False)
    few = spark.range(5).select(F.col("id").alias("k"))
    hot = spark.range(3000).select(F.lit(1).alias("rk"), F.col("id").alias("v"))
    joined = skew.balanced_join(few, hot, [("k", "rk")], "left")
    assert "explode" in optimized(joined)
    assert joined.count() == 3004


def test_no_heavy_keys_no_slices(left, right):
    split = skew.split_join(left, right, [("k", "rk")], "left")
    assert "explode" not in optimized(split)


def test_broadcast_sides_get_the_plain_join(spark, left, counted):
    few = spark.range(5).select(F.col("id").alias("rk"))
    joined = skew.balanced_join(left, few, [("k", "rk")], "left")
    assert "explode" not in optimized(joined) and not counted
    assert skew.will_broadcast(spark.range(10))
    # Rows of unknown size never count as small.
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "x int")
    assert not skew.will_broadcast(unknown)
