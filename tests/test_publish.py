"""Outputs that switch in one step, and ids that stay over several runs."""

import random

import pytest

from conftest import rows
from mapweave.operators.key_registry import KeyRegistry
from mapweave.sources import publish
from mapweave.sources.storage import Staging


def test_outputs_count_once_all_are_written(spark, tmp_path):
    out = str(tmp_path / "out")
    assert publish.published(spark, out) is None
    with publish.publication(spark, out) as first:
        spark.range(3).write.parquet(f"{first}/t")
        assert publish.published(spark, out) is None
    assert publish.published(spark, out) == first
    with pytest.raises(KeyError), publish.publication(spark, out) as broken:
        spark.range(9).write.parquet(f"{broken}/t")
        raise KeyError
    assert publish.published(spark, out) == first and spark.read.parquet(f"{first}/t").count() == 3
    folders = [first]
    for _ in range(3):
        with publish.publication(spark, out) as folder:
            spark.range(4).write.parquet(f"{folder}/t")
        folders.append(folder)
    # The run before stays for its readers, older ones go.
    assert sorted(p.name for p in (tmp_path / "out/runs").iterdir()) == sorted(f.rsplit("/", 1)[1] for f in folders[-2:])


def test_runs_whose_driver_died_are_forgotten(spark, tmp_path):
    out = str(tmp_path)
    with publish.publication(spark, out) as folder:
        spark.range(1).write.parquet(f"{folder}/t")
    (tmp_path / "runs" / "dead" / "t").mkdir(parents=True)
    assert publish.forget_broken(spark, out) == ["dead"]
    assert publish.published(spark, out) == folder and spark.read.parquet(f"{folder}/t").count() == 1


def test_a_small_file_is_replaced(spark, tmp_path):
    path = str(tmp_path / "a" / "f")
    assert publish.read_file(spark, path) is None
    for text in ("one", "zwei \u00e9", ""):
        publish.replace_file(spark, path, text)
        assert publish.read_file(spark, path) == text
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")] == ["f"]


SCHEMA = "part0 string, part1 int"


def numbered(spark, registry, data, parts=("a", "b")):
    keys = Staging(spark).cut(spark.createDataFrame(data, SCHEMA))
    return {(r.part0, r.part1): r.id for r in registry.numbered(parts, keys).collect()}


@pytest.mark.parametrize("tables", [2, 32])
def test_keys_keep_their_ids_over_growing_runs(spark, tmp_path, monkeypatch, tables):
    from mapweave.operators import key_registry

    monkeypatch.setattr(key_registry, "TABLES", tables)
    draw, seen, registry = random.Random(3), {}, KeyRegistry(spark, str(tmp_path))
    for size in (0, 6, 6, 15, 30, 30):
        data = [(draw.choice("abc"), draw.randrange(size + 1)) for _ in range(size)] + [("a", None), (None, 1)]
        found = numbered(spark, registry, data + data)
        assert set(found) == {k for k in data if None not in k}
        assert all(found[k] == seen[k] for k in found if k in seen)
        seen |= found
        assert sorted(seen.values()) == list(range(len(seen)))
        before = publish.read_file(spark, f"{registry.folder(('a', 'b'))}/CURRENT")
        assert numbered(spark, registry, data) == found
        assert publish.read_file(spark, f"{registry.folder(('a', 'b'))}/CURRENT") == before
    assert {(r[0], r[1]): r[2] for r in rows(registry.known(("a", "b")))} == seen


def test_registries_of_other_parts_do_not_meet(spark, tmp_path):
    registry = KeyRegistry(spark, str(tmp_path))
    one = numbered(spark, registry, [("a", 1), ("b", 2)], ("x", "y"))
    other = numbered(spark, registry, [("c", 3)], ("y", "x"))
    assert sorted(one.values()) == [0, 1] and list(other.values()) == [0]
    with pytest.raises(ValueError, match="registered as"):
        registry.numbered(("x", "y"), spark.createDataFrame([(1, 1)], "part0 int, part1 int"))


def test_a_broken_run_adds_no_keys(spark, tmp_path, monkeypatch):
    from mapweave.operators import key_registry

    registry = KeyRegistry(spark, str(tmp_path))
    first = numbered(spark, registry, [("a", 1)])
    replace = key_registry.replace_file

    def broken(*args):
        raise OSError("the run ends here")

    monkeypatch.setattr(key_registry, "replace_file", broken)
    with pytest.raises(OSError):
        numbered(spark, registry, [("a", 1), ("b", 2), ("c", 3)])
    monkeypatch.setattr(key_registry, "replace_file", replace)
    assert numbered(spark, registry, [("a", 1), ("d", 4)]) == first | {("d", 4): 1}
