"""Binary files on any file system that Spark can write.

Spark's text writer copies the bytes of a string column as they are and puts a
separator after every row. Records that end in a zero byte are therefore written
without it, with a zero byte as separator, and the files hold exactly the records,
one after another. The commit protocol of the writer makes a lost executor or a
second attempt harmless. Files are read whole, one row each, so their size has to be
bounded: by the number of records in a file, or by a folder that the records state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = b"\0"


def write_records(
    records: DataFrame, column: str, path: str, records_per_file: int = 0, folder: str | None = None
) -> None:
    """Write the binary ``column``, whose values lack their final zero byte, in row order.

    A task writes a file for each value of ``folder``, if given, or for ``records_per_file`` records.
    """
    value = F.col(column).cast("string").alias("value")
    writer = records.select(value, *([folder] if folder else [])).write.option("lineSep", "\0").option("compression", "none")
    writer = writer.partitionBy(folder) if folder else writer
    writer.option("maxRecordsPerFile", records_per_file).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content): every data file of a folder."""
    return spark.read.format("binaryFile").load(path).select("path", "content")
