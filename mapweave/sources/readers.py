"""Records, rules and dictionaries from JSON; lists from directories of CSV files."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.sources.csv_records import csv_records
from mapweave.sources.json_arrays import array_records
from mapweave.sources.split_rows import larger_than_a_split
from mapweave.sources.storage import Staging, list_directory
from mapweave.sources.writers import CSV_FORMAT


def all_string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# Between staged records: a character that JSON does not allow as it is.
RECORD_END = "\x01"


def _names(texts: DataFrame) -> list[str]:
    """All names of the objects in ``texts``, in order. Types are not looked at."""
    several = F.from_json("value", "array<map<string,string>>")
    keys = F.when(F.ltrim("value").startswith("["), F.flatten(F.transform(several, F.map_keys)))
    found = texts.select(F.explode(F.coalesce(keys, F.json_object_keys("value"))).alias("name")).distinct()
    return sorted(row["name"] for row in found.collect())


def read_json_strings(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    lines: bool = False,
    staging: Staging | None = None,
    split_bytes: int | None = None,
) -> DataFrame:
    """Read JSON records with every column as text; a malformed document is an error.

    The default format is one JSON array per file. Files of more than ``split_bytes`` (by
    default what the session reads in one task) are read by many tasks, as in
    ``json_arrays``; they must hold an array of objects. Such a file is read once and staged as
    one text a record, for as long as ``staging`` lasts. JSON lines (``lines=True``) split by
    themselves. Without ``columns``, names alone are gathered in a pass of their own, for
    large arrays over the staged texts.
    """
    options = {"multiLine": not lines, "mode": "FAILFAST"}
    if lines:
        if columns is None:
            columns = _names(spark.read.text(path))
        return spark.read.json(path, schema=all_string_schema(columns), **options)
    large, small = larger_than_a_split(spark, path, split_bytes)
    if not large:
        if columns is None:
            columns = spark.read.json(path, **options).columns
        return spark.read.json(path, schema=all_string_schema(columns), **options)
    staging = staging or Staging(spark)
    staged = staging.folder(f"records_{uuid4().hex}")
    # Staged as text, since only the reader of files keeps numbers and nested values as they are.
    array_records(spark, large, staging).write.option("lineSep", RECORD_END).text(staged)
    if columns is None:
        found = set(_names(spark.read.option("lineSep", RECORD_END).text(staged)))
        columns = sorted(found.union(spark.read.json(small, **options).columns if small else ()))
    schema = all_string_schema(columns)
    records = spark.read.json(staged, schema=schema, lineSep=RECORD_END, mode="FAILFAST")
    return records.unionByName(spark.read.json(small, schema=schema, **options)) if small else records


def read_csv(spark: SparkSession, path: str, staging: Staging | None = None, split_bytes: int | None = None) -> DataFrame:
    """A CSV file, or a directory of them with equal headers, as ``write_csv`` writes it: all text.

    Cells may hold separators, quotes and line breaks. Files of more than ``split_bytes`` (by
    default what the session reads in one task) are read by many tasks, as in
    ``csv_records``; staged tables then last as long as ``staging``. Rows with more or fewer
    cells than the header are an error.
    """
    options = {**CSV_FORMAT, "mode": "FAILFAST"}
    read = spark.read.options(**options, multiLine=True, header=True)
    large, small = larger_than_a_split(spark, path, split_bytes)
    if not large:
        return read.csv(path)
    schema = all_string_schema(read.csv((small or large)[0]).columns)
    texts = csv_records(spark, large, staging or Staging(spark), CSV_FORMAT["sep"])
    ddl = ", ".join("`{}` string".format(c.replace("`", "``")) for c in schema.names)
    cells = texts.select(F.from_csv("value", ddl, options).alias("cells")).select("cells.*")
    return cells.unionByName(read.schema(schema).csv(small)) if small else cells


def read_lists(spark: SparkSession, directory: str, staging: Staging | None = None) -> list[DataFrame]:
    """Every entry of a directory as its own list: header row, all text, by name."""
    return [read_csv(spark, path, staging) for path in list_directory(spark, directory)]
