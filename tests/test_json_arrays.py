"""Arrays read in splits against Spark's own reader, on nested, quoted and escaped text."""

import json
import random

import pytest

import __spark_entry__ as entry
from conftest import rows
from mapweave.sources import readers, split_rows
from mapweave.sources.json_arrays import array_records
from mapweave.sources.split_rows import read_rows
from mapweave.sources.storage import Staging

BITS = ["a", "é", "漢", '"', "\\", "{", "}", "[", "]", ",", ":", "\n", "\t", "/", "😀", '\\"', "}]", "},{", ""]


def some_text(draw):
    return "".join(draw.choice(BITS) for _ in range(draw.randint(0, 9)))


def some_value(draw, depth=0):
    kind = draw.randint(0, 7 if depth < 3 else 4)
    if kind == 5:
        return [some_value(draw, depth + 1) for _ in range(draw.randint(0, 3))]
    if kind >= 6:
        return {some_text(draw) or "k": some_value(draw, depth + 1) for _ in range(draw.randint(0, 3))}
    return draw.choice([some_text(draw), some_text(draw), draw.random(), None, True])


def some_records(draw, count):
    names = ["id", "name", "nested", 'quo"ted', "br{ace", "back\\slash"]
    return [{n: some_value(draw) for n in draw.sample(names, draw.randint(0, 6))} for _ in range(count)]


@pytest.fixture
def small_splits(spark):
    """Splits of a few bytes, so that most records cross one."""
    names = {"spark.sql.files.maxPartitionBytes": "397", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "12"}
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("seed", range(4))
def test_records_are_those_of_the_one_task_reader(spark, tmp_path, small_splits, seed):
    draw = random.Random(seed)
    style = [{}, {"indent": 1}, {"ensure_ascii": False}, {"separators": (",", ":")}][seed]
    for n, count in enumerate((30, 3)):
        (tmp_path / f"{n}.json").write_text(json.dumps(some_records(draw, count), **style) + "\n" * (seed % 2))
    expected = spark.read.json(str(tmp_path), multiLine=True, mode="FAILFAST")
    expected = spark.read.json(str(tmp_path), schema=readers.all_string_schema(expected.columns), multiLine=True)
    got = readers.read_json_strings(spark, str(tmp_path), split_bytes=0)
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)
    some = readers.read_json_strings(spark, str(tmp_path), columns=["nested", "later"], split_bytes=0)
    assert rows(some) == rows(expected.selectExpr("nested", "null"))


def test_many_tasks_read_one_file(spark, tmp_path, small_splits):
    path = tmp_path / "r.json"
    path.write_text(json.dumps([{"id": i, "t": "}{" * (i % 4)} for i in range(400)]))
    texts = array_records(spark, [str(path)], Staging(spark))
    assert sorted(json.loads(r.value)["id"] for r in texts.collect()) == list(range(400))
    assert read_rows(spark, [str(path)], "}").select("block").distinct().count() > 20


def test_large_and_small_files_together(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "x": i, "y": {"z": [1]}} for i in range(49)])[:-1] + ', {"id": 1e3, "x": 2.50, "y": {"z" : 0.10}}]')
    (tmp_path / "b.json").write_text('[{"id": 50, "y": 1.50}]')
    got = readers.read_json_strings(spark, str(tmp_path), split_bytes=100)
    assert got.columns == ["id", "x", "y"]
    assert got.count() == 51 and {("50", None, "1.50"), ("1e3", "2.50", '{"z" : 0.10}')} <= set(rows(got))


@pytest.mark.parametrize("text", ["[]", " [ \n ] \n"])
def test_an_empty_array_has_no_records(spark, tmp_path, text):
    (tmp_path / "r.json").write_text(text)
    assert readers.read_json_strings(spark, str(tmp_path), columns=["id"], split_bytes=0).count() == 0


BROKEN = [
    '[{"id": 1}, {"id": ', '[{"id": 1}, {"id": 2}', '[{"id": 1}', '[{"id": 1},', '[{"id": 1} {"id": 2}]', '{"id": 1}',
    '[{"id": 1}, 7]', '[{"id": 1}],', '[{"id": 1}]]', '[{"id": 1}, [{"id": 2}]]', '[{"id": "1}]', '[{"id": 1},,{"id": 2}]',
    '[{"id": 1]}, {"id": 2}]', '[{"id": 1}][{"id": 2}]', '[{"id" 1}]', '[{"id": {"a": 1}]', '["id": 1}]', "[", "x",
]


@pytest.mark.parametrize("text", BROKEN)
def test_broken_arrays_are_errors(spark, tmp_path, text):
    (tmp_path / "r.json").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_json_strings(spark, str(tmp_path), columns=["id"], split_bytes=0).collect()


def test_lines_are_named_in_order_without_types(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    path.write_text('{"b": 1.50, "a": {"k": [1, 2]}}\n\n  \n[{"c": "x"}, {"a": true}]\n{"é\\"": null}\n')
    old = spark.read.json(str(path), mode="FAILFAST")
    expected = spark.read.json(str(path), schema=readers.all_string_schema(old.columns))
    got = readers.read_json_strings(spark, str(path), lines=True)
    assert got.columns == old.columns and rows(got) == rows(expected)
    path.write_text('{"b": 1}\n{"b": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_json_strings(spark, str(path), lines=True).collect()


def test_what_a_task_orders_does_not_grow_with_the_files(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(split_rows, "TASK_BYTES", 1000)
    path = tmp_path / "records.json"
    path.write_text(json.dumps([{"id": i, "nested": {"a": [i]}} for i in range(300)]))
    tasks = path.stat().st_size // 1000 + 1
    texts = array_records(spark, [str(path)], Staging(spark))
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert tasks > 5 and f", {tasks}), REPARTITION_BY_NUM" in plan
    assert sorted(json.loads(r.value)["id"] for r in texts.collect()) == list(range(300))


def test_arrays_of_the_query_stay_short_if_keys_repeat(spark, tmp_path, monkeypatch):
    read = []
    monkeypatch.setattr(entry, "read_json_strings", lambda spark, path, split_bytes: read.append(path))
    columns = "7L AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, CAST(1 AS DOUBLE) AS o_totalprice, '1-URGENT' AS o_orderpriority"
    spark.range(0, 41000, 1, 1).selectExpr(*columns.split(", ")).write.parquet(str(tmp_path / "orders.parquet"))
    entry.json_array(spark, str(tmp_path))
    sizes = [len(json.loads(r.value)) for r in spark.read.text(read[0], wholetext=True).collect()]
    assert sum(sizes) == 41000 and max(sizes) <= 20000
