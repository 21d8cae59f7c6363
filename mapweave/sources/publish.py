"""Outputs that appear as a whole or not at all.

A run writes into a folder of its own under ``runs``. One small file, ``CURRENT``, names the run whose
outputs count; replacing it is the single switch. A run that breaks, wherever it does, leaves
the outputs of the earlier run as they were, and readers that began with those go on with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

from mapweave.sources.storage import hadoop_path

CURRENT = "CURRENT"


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Put ``text`` in place of a small file in one step."""
    fs, target = hadoop_path(spark, path)
    _, fresh = hadoop_path(spark, f"{path}.{uuid4().hex}")
    fs.mkdirs(target.getParent())
    stream = fs.create(fresh, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    overwrite[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), overwrite)


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None where there is none."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def run_folder(directory: str, run: str) -> str:
    return f"{directory}/runs/{run}"


def published(spark: SparkSession, directory: str) -> str | None:
    """The folder of the outputs that count, or None before the first run."""
    run = read_file(spark, f"{directory}/{CURRENT}")
    return run_folder(directory, run) if run else None


@contextmanager
def publication(spark: SparkSession, directory: str, keep: int = 1) -> Iterator[str]:
    """A folder to write into; its outputs count once the block ends without an error.

    The ``keep`` runs published before stay for their readers, older ones are deleted. A broken run
    is deleted at once; one whose driver died stays unread until ``forget_broken``.
    """
    run = uuid4().hex
    folder = run_folder(directory, run)
    try:
        yield folder
        earlier = (read_file(spark, f"{directory}/HISTORY") or "").split()
        before = read_file(spark, f"{directory}/{CURRENT}")
        replace_file(spark, f"{directory}/{CURRENT}", run)
    except BaseException:
        _delete(spark, folder)
        raise
    earlier = [*(r for r in earlier if r != before), *([before] if before else [])]
    kept = earlier[len(earlier) - min(keep, len(earlier)) :]
    replace_file(spark, f"{directory}/HISTORY", "\n".join(kept))
    for old in earlier[: len(earlier) - len(kept)]:
        _delete(spark, run_folder(directory, old))


def forget_broken(spark: SparkSession, directory: str) -> list[str]:
    """Delete run folders that were never published; no run may be going on."""
    fs, target = hadoop_path(spark, f"{directory}/runs")
    known = {*(read_file(spark, f"{directory}/HISTORY") or "").split(), read_file(spark, f"{directory}/{CURRENT}")}
    broken = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    broken = sorted(set(broken) - known)
    for run in broken:
        _delete(spark, run_folder(directory, run))
    return broken


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)
