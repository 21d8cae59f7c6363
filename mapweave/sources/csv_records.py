"""Large CSV files with line breaks inside cells, read by many tasks.

A file is read in splits, line by line. Each line maps the state before it, outside or inside a quoted
cell, to the state behind it. Such maps are put together inside each split, then over the
splits of a file, which tells for every line whether a record begins there.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mapweave.sources.split_rows import SPLIT, ahead, gathered, malformed, read_rows, tasks_for, whole
from mapweave.sources.storage import Staging

WHAT = "CSV file"


def _open_after(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether a quoted cell is open behind a line that begins outside, and inside, one.

    A quote opens a cell only at its start. Behind the closing quote, anything up to
    the separator still belongs to the cell. Doubled quotes change nothing.
    """
    mark = re.escape(sep)
    plain = F.replace(line, F.lit('""'), F.lit(""))

    def open_in(text: Column) -> Column:
        rest = F.regexp_replace(text, rf'(^|{mark})"[^"]*"[^{mark}]*', "$1")
        return rest.rlike(rf'(^|{mark})"')

    behind = F.regexp_replace(plain, rf'^[^"]*"[^{mark}]*', "")
    # What is left behind the first cell begins with a separator.
    inside = F.when(~plain.contains('"'), F.lit(True)).otherwise((behind != "") & open_in(behind))
    return open_in(plain).cast("int"), inside.cast("int")


def _states(rows: DataFrame, part: list[str], order: str) -> DataFrame:
    """Add ``before_0`` and ``before_1``: the state before each row if the first begins in 0 or 1.

    ``after_0`` and ``after_1`` of a row are its map. Behind a row that maps both to one state, that
    state holds whatever was before; else a state is kept or turned round.
    """
    before = ahead(Window.partitionBy(*part).orderBy(order))
    turns, fixed = F.col("after_0") > F.col("after_1"), F.col("after_0") == F.col("after_1")
    rows = rows.withColumn("turned", F.coalesce(F.sum(turns.cast("long")).over(before), F.lit(0)))
    told = F.when(fixed, F.struct(F.col("after_0").alias("state"), "turned"))
    rows = rows.withColumn("told", F.last(told, ignorenulls=True).over(before))
    known = (F.col("told.state") + F.col("turned") - F.col("told.turned")) % 2
    states = {f"before_{s}": F.coalesce(known, (F.col("turned") + s) % 2).cast("int") for s in (0, 1)}
    return rows.withColumns(states).drop("turned", "told")


def _behind(state: str) -> Column:
    return F.when(F.col(state) == 0, F.col("after_0")).otherwise(F.col("after_1"))


def _split_starts(rows: DataFrame) -> DataFrame:
    """(file, block, start, first, crlf): a row for each split.

    ``start`` is the state it begins in, ``first`` numbers the file's first row, and ``crlf`` says
    whether that row, and so the lines of the file, end in a carriage return and a line feed.
    """
    splits = rows.groupBy(*SPLIT).agg(
        F.max_by(_behind("before_0"), "nth").alias("after_0"),
        F.max_by(_behind("before_1"), "nth").alias("after_1"),
        F.min("nth").alias("first"),
        F.min_by(F.col("value").endswith("\r"), "nth").alias("crlf"),
    )
    order = Window.partitionBy("file").orderBy("block")
    first = F.when(F.lag("block").over(order).isNull(), F.col("first"))
    columns = ["before_0", first.alias("first"), F.first("crlf").over(order).alias("crlf")]
    return _states(splits, ["file"], "block").select(*SPLIT, *columns).withColumnRenamed("before_0", "start")


def csv_records(spark: SparkSession, paths: list[str], staging: Staging, sep: str = ",") -> DataFrame:
    """(value): the text of every record but the first, the header, of each file.

    The files are UTF-8 and lines end in a line feed. Where a file's first line has a carriage
    return before it, those of its other lines count as part of the line break too. Cells are
    quoted by double quotes, which are doubled inside. A cell left open at the end of a file is an
    error when the records are read; blank lines between records are none. Staged
    tables last as long as ``staging``.
    """
    rows = read_rows(spark, paths, "\n")
    zero, one = _open_after(F.col("value"), sep)
    rows = rows.withColumns({"after_0": zero, "after_1": one})
    tasks = tasks_for(spark, paths)
    rows = staging.cut(_states(rows.repartition(tasks, *SPLIT), SPLIT, "nth"))
    placed = rows.join(staging.cut(_split_starts(rows)), SPLIT)
    state = F.when(F.col("start") == 0, F.col("before_0")).otherwise(F.col("before_1"))
    placed = placed.withColumn("state", state).select(
        *SPLIT,
        "nth",
        "value",
        F.struct(F.col("nth").eqNullSafe(F.col("first")).alias("header"), "crlf").alias("lead"),
        (F.col("state") == 0).alias("begins"),
        (_behind("state") == 0).alias("ends"),
    )
    # A record that begins but never ends has all lines behind it.
    many = gathered(placed, "\n", tasks)
    several = F.when(F.col("complete"), F.col("value")).otherwise(malformed(WHAT, F.col("file")))
    found = whole(placed).unionByName(many.select("file", several.alias("value"), "lead")).where("NOT lead.header")
    plain = F.replace(F.regexp_replace("value", r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))
    return found.select(F.when(F.col("lead.crlf"), plain).otherwise(F.col("value")).alias("value")).where("value != ''")
