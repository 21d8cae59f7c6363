"""Records of one file put together from rows that many tasks read.

Large files are read in splits, as rows that end at a separator. A format says of each row whether a
record may begin with it and whether one ends with it. A record that lies in one row is
taken as it stands; the others are gathered inside their split, and the few that cross from one
split to another are gathered once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLIT = ["file", "block"]
# Bytes of text that a task orders at a time; a split, which is one group, may be larger.
TASK_BYTES = 8 << 20


def read_rows(spark: SparkSession, paths: list[str], separator: str) -> DataFrame:
    """(file, block, nth, value): rows without their separator, in order of (block, nth) in a file.

    A row that reaches over the end of a split belongs to the split it begins in.
    """
    return spark.read.option("lineSep", separator).text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        "value",
    )


def ahead(order: Window) -> Window:
    return order.rowsBetween(Window.unboundedPreceding, -1)


def malformed(what: str, file: Column) -> Column:
    """An error for whoever reads the value."""
    return F.raise_error(F.concat(F.lit(f"malformed {what}: "), file)).cast("string")


def larger_than_a_split(spark: SparkSession, path: str | list[str], most: int | None = None) -> tuple[list[str], list[str]]:
    """Files of more bytes than one task reads, and the others. No content is read."""
    if most is None:
        most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    files = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    large = sorted(f.path for f in files if f.length > most)
    return large, sorted(f.path for f in files if f.length <= most)


def tasks_for(spark: SparkSession, paths: list[str]) -> int:
    """Tasks that share the text of files, so that what each orders does not grow with the files."""
    total = spark.read.format("binaryFile").load(paths).agg(F.sum("length")).first()[0] or 0
    return total // TASK_BYTES + 1


def whole(placed: DataFrame) -> DataFrame:
    """(file, value, lead): records that lie in one row."""
    return placed.where("begins AND ends").select("file", "value", "lead")


def gathered(placed: DataFrame, separator: str, tasks: int) -> DataFrame:
    """(file, value, lead, complete): records of several rows; ``lead`` is that of the first.

    A record that does not begin, or does not end, is not complete. Rows are numbered in their
    split by how many records began there; those of a record that an earlier split began
    have number 0 and are numbered on by the records begun before. ``tasks`` share the rows.
    """
    rows = placed.where("NOT (begins AND ends)").repartition(tasks, *SPLIT)
    begun = F.sum(F.col("begins").cast("long"))
    inside = Window.partitionBy(*SPLIT).orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    pieces = rows.withColumn("number", begun.over(inside)).groupBy(*SPLIT, "number").agg(
        F.array_sort(F.collect_list(F.struct("nth", "value"))).alias("parts"),
        F.min_by("lead", "nth").alias("lead"),
        F.max("begins").alias("begins"),
        F.max("ends").alias("ends"),
    )
    pieces = pieces.withColumn("value", F.array_join(F.col("parts.value"), separator)).drop("parts")
    complete = F.col("begins") & F.col("ends")
    in_file = Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, 0)
    crossing = pieces.where(~complete).withColumn("record", begun.over(in_file))
    joined = crossing.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "number", "value"))).alias("parts"),
        F.min_by("lead", F.struct("block", "number")).alias("lead"),
        F.max("begins").alias("begins"),
        F.max("ends").alias("ends"),
    )
    joined = joined.withColumn("value", F.array_join(F.col("parts.value"), separator))
    columns = ["file", "value", "lead"]
    inner = pieces.where(complete).select(*columns, F.lit(True).alias("complete"))
    return inner.unionByName(joined.select(*columns, complete.alias("complete")))
