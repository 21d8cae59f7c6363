import json

import pytest

from conftest import rows
from mapweave.sources import readers, writers
from mapweave.sources.storage import Staging, list_directory

RECORDS = [
    {"id": 17, "name": "a", "price": 1.50, "nested": {"k": [1, 2]}, "flag": True},
    {"id": "18", "name": None, "extra": ""},
]


def write(path, text):
    path.write_text(text)
    return str(path)


def test_json_array_as_text(spark, tmp_path):
    text = '[{"id": 17, "p": 1.50, "e": 1e3, "n": {"k":[1,2]}, "b": true},\n {"id": "18", "p": null}]'
    df = readers.read_json_strings(spark, write(tmp_path / "r.json", text))
    assert df.columns == ["b", "e", "id", "n", "p"]
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows(df) == [
        (None, None, "18", None, None),
        ("true", "1e3", "17", '{"k":[1,2]}', "1.50"),
    ]


def test_json_lines_and_given_columns(spark, tmp_path):
    path = write(tmp_path / "r.jsonl", "\n".join(json.dumps(r) for r in RECORDS))
    df = readers.read_json_strings(spark, path, columns=["name", "id", "later"], lines=True)
    assert rows(df) == [(None, "18", None), ("a", "17", None)]


def test_malformed_json_is_an_error(spark, tmp_path):
    path = write(tmp_path / "r.json", '[{"id": 1}, {"id": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_json_strings(spark, path, columns=["id"]).collect()


def test_lists_come_by_name_and_all_text(spark, tmp_path):
    write(tmp_path / "b.csv", "k,v\n1,\n2,\"a, b\"\n")
    write(tmp_path / "a.csv", "k\n7\n")
    write(tmp_path / "_SUCCESS", "")
    spark.createDataFrame([("x", "y")], "p string, q string").write.csv(str(tmp_path / "c"), header=True)
    lists = readers.read_lists(spark, str(tmp_path))
    assert [df.columns for df in lists] == [["k"], ["k", "v"], ["p", "q"]]
    assert rows(lists[1]) == [("1", None), ("2", "a, b")]
    assert rows(lists[2]) == [("x", "y")]
    assert len(list_directory(spark, str(tmp_path))) == 3


def test_malformed_list_is_an_error(spark, tmp_path):
    write(tmp_path / "a.csv", "k,v\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_lists(spark, str(tmp_path))[0].collect()


def text_of(directory):
    return "".join(sorted(p.read_text() for p in directory.glob("part-*")))


def test_csv_format(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", twice', ""), (2, None, "x")], "n int, a string, b string")
    writers.write_csv(df.coalesce(1), str(tmp_path / "out"))
    assert text_of(tmp_path / "out") == 'n,a,b\n1,"say ""hi"", twice",\n2,,x\n'
    writers.write_report(df.coalesce(1).select("n"), str(tmp_path / "out"))
    assert text_of(tmp_path / "out") == "1\n2\n"


def test_one_output_per_table(spark, tmp_path):
    writers.write_tables({"a": spark.range(2), "b": spark.range(3)}, str(tmp_path))
    assert sorted(p.name for p in (tmp_path / "tables").iterdir()) == ["a", "b"]
    assert spark.read.csv(str(tmp_path / "tables/b"), header=True).count() == 3


def test_database_loading_appends_every_table(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    calls = []
    monkeypatch.setattr(
        DataFrameWriter, "jdbc",
        lambda self, url, table, mode=None, properties=None: calls.append((url, table, mode, properties)),
    )
    writers.load_tables({"a": spark.range(1), "b": spark.range(1)}, "jdbc:x", {"user": "u"})
    assert calls == [("jdbc:x", "a", "append", {"user": "u"}), ("jdbc:x", "b", "append", {"user": "u"})]


def test_staging_uses_the_shared_folder(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    staging = Staging(spark)
    if before:
        assert staging.path.startswith(before)
    table = staging.table(spark.range(5), "five")
    assert table.count() == 5
    assert table.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(staging.path.split(":")[-1].lstrip("/"))
    staging.remove()


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Conf:
        @staticmethod
        def get(name, default=None):
            return {"spark.master": "yarn"}.get(name, default)

    class Session:
        conf = Conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        Staging(Session)
