"""Paths on the cluster's file systems, and staged tables."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def list_directory(spark: SparkSession, path: str) -> list[str]:
    """Entries of a directory on any Hadoop file system, sorted by name.

    Names starting with "_" or "." are markers, not data.
    """
    fs, target = hadoop_path(spark, path)
    entries = [status.getPath() for status in fs.listStatus(target)]
    visible = [e for e in entries if not e.getName().startswith(("_", "."))]
    return [e.toString() for e in sorted(visible, key=lambda e: e.getName())]


class Staging:
    """Tables written to the cluster's shared folder to cut lineage.

    A staged table survives the loss of executors and is read back with column
    pruning and real size statistics. The folder is the session's
    ``spark.checkpoint.dir``, or else the one given to ``setCheckpointDir``; only a
    local session without either gets a temporary one.
    """

    def __init__(self, spark: SparkSession):
        root = spark.conf.get("spark.checkpoint.dir", None)
        context = getattr(spark, "sparkContext", None)
        if not root and context is not None:
            root = context.getCheckpointDir()
        if not root:
            if not spark.conf.get("spark.master", "").startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="mapweave-")
        self._spark = spark
        self.path = f"{root}/mapweave-{uuid4().hex}"

    def table(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Write ``df`` as a table and return the written table."""
        path = f"{self.path}/{name}"
        df.write.parquet(path, partitionBy=partition_by)
        return self._spark.read.schema(df.schema).parquet(path)

    def cut(self, df: DataFrame) -> DataFrame:
        """Write and read back ``df`` under a name of its own."""
        return self.table(df, f"cut_{uuid4().hex}")

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def remove(self) -> None:
        """Delete this run's staged tables; nothing read from them works afterwards."""
        fs, target = hadoop_path(self._spark, self.path)
        fs.delete(target, True)
