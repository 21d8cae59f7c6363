"""Large JSON array documents, read by many tasks.

A file is read in splits, as rows that end at a closing brace. Whether such a brace ends a record
depends on all that stands before it: on whether a string is open, and on how many brackets
are. Both are running totals. They are worked out inside each split for either state it may
begin in, then over the few splits of a file, which says in which state each really begins.
Rows are then put together to the text of one record each.

The text is shuffled and staged once. A record that lies in one row, as every flat one does, needs
no more; the rows of others meet by their number. All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mapweave.sources.split_rows import SPLIT, ahead, gathered, malformed, read_rows, tasks_for, whole
from mapweave.sources.storage import Staging

WHAT = "JSON array"
_BLANK = r"[ \t\r\n]*"
# What may stand in front of the first record, of another one, and at the end of a file.
_FIRST = rf"^\ufeff?{_BLANK}\[{_BLANK}\{{"
_NEXT = rf"^{_BLANK},{_BLANK}\{{"
_LEAD = rf"^\ufeff?{_BLANK}[\[,]{_BLANK}"
_END = rf"^{_BLANK}\]{_BLANK}$"
_NO_RECORD = rf"^\ufeff?{_BLANK}\[{_BLANK}\]{_BLANK}$"


def _depth(text: Column) -> Column:
    """Brackets and braces that ``text`` opens, less those it closes, outside strings."""
    bare = F.regexp_replace(text, r'"[^"]*(?:"|\z)', "")
    opened = F.length(bare) - F.length(F.translate(bare, "{[", ""))
    closed = F.length(bare) - F.length(F.translate(bare, "]", ""))
    return opened - closed


def _rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, block, nth, value, quotes, outside, inside): text up to each closing brace.

    ``quotes`` is the parity of quotes in the row, ``outside`` and ``inside`` what it adds to
    the depth if it begins outside or inside a string. A row follows a brace, so it never
    begins behind a backslash.
    """
    rows = read_rows(spark, paths, "}").withColumn("plain", F.regexp_replace("value", r"(?s)\\.", ""))
    quotes = (F.length("plain") - F.length(F.translate("plain", '"', ""))) % 2
    in_string = F.regexp_replace("plain", r'^[^"]*(?:"|\z)', "")
    columns = {"quotes": quotes, "outside": _depth(F.col("plain")), "inside": _depth(in_string)}
    return rows.withColumns(columns).drop("plain")


def _running(rows: DataFrame) -> DataFrame:
    """Add ``odd``, whether quotes are open before the row, and ``depth_0``, ``depth_1`` before it.

    All count from the start of the split, the depths for a split that begins outside and inside
    a string. ``more_0`` and ``more_1`` are what the row and its brace add.
    """
    before = ahead(Window.partitionBy(*SPLIT).orderBy("nth"))
    rows = rows.withColumn("odd", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    for start in (0, 1):
        odd = (F.col("odd") + start) % 2
        brace = F.when((odd + F.col("quotes")) % 2 == 0, -1).otherwise(0)
        rows = rows.withColumn(f"more_{start}", F.when(odd == 0, F.col("outside")).otherwise(F.col("inside")) + brace)
    depths = {f"depth_{s}": F.coalesce(F.sum(f"more_{s}").over(before), F.lit(0)) for s in (0, 1)}
    return rows.withColumns(depths).drop("outside", "inside")


def _split_starts(rows: DataFrame) -> DataFrame:
    """(file, block, open, start, last): the state in which each split begins, a row for each.

    ``open`` is 1 inside a string and ``start`` the depth; ``last`` numbers the last row of the
    file's last split.
    """
    splits = rows.groupBy(*SPLIT).agg(
        F.sum("quotes").alias("quotes"),
        F.sum("more_0").alias("more_0"),
        F.sum("more_1").alias("more_1"),
        F.max("nth").alias("last"),
    )
    order = Window.partitionBy("file").orderBy("block")
    before = ahead(order)
    splits = splits.withColumn("open", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    more = F.when(F.col("open") == 0, F.col("more_0")).otherwise(F.col("more_1"))
    splits = splits.withColumn("more", more).withColumn("start", F.coalesce(F.sum("more").over(before), F.lit(0)))
    final = F.lead("block").over(order).isNull()
    return splits.select("file", "block", "open", "start", F.when(final, F.col("last")).alias("last"))


def array_records(spark: SparkSession, paths: list[str], staging: Staging) -> DataFrame:
    """(value): the text of every record of files that hold one array of objects each.

    The files are UTF-8. A file cut short, text between records other than one comma, and elements
    that are no objects are errors when the records are read; an empty array has none. What
    is inside a record is left to the JSON parser. Staged tables last as long as ``staging``.
    """
    tasks = tasks_for(spark, paths)
    rows = staging.cut(_running(_rows(spark, paths).repartition(tasks, *SPLIT)))
    starts = staging.cut(_split_starts(rows))
    placed = rows.join(starts, SPLIT)
    odd = (F.col("odd") + F.col("open")) % 2
    depth = F.col("start") + F.when(F.col("open") == 0, F.col("depth_0")).otherwise(F.col("depth_1"))
    more = F.when(F.col("open") == 0, F.col("more_0")).otherwise(F.col("more_1"))
    placed = placed.select(
        *SPLIT,
        "nth",
        "value",
        F.col("nth").eqNullSafe(F.col("last")).alias("tail"),
        depth.alias("lead"),
        ((odd == 0) & (depth <= 1)).alias("begins"),
        ((depth + more == 1) & ((odd + F.col("quotes")) % 2 == 0)).alias("ends"),
    )
    rows, tails = placed.where("NOT tail"), placed.where("tail")
    many = gathered(rows, "}", tasks)
    file, opened = F.col("file"), F.concat(_opened(), F.lit("}"))
    several = F.when(F.col("complete"), opened).otherwise(malformed(WHAT, file))
    # No rows, but an error for files that do not end as an array ends.
    fits = F.when(F.col("lead") == 0, F.col("value").rlike(_NO_RECORD)).otherwise(F.col("begins") & F.col("value").rlike(_END))
    ended = tails.select(F.when(~fits, malformed(WHAT, file)).alias("value")).where("value IS NOT NULL")
    return whole(rows).select(opened.alias("value")).unionByName(many.select(several.alias("value"))).unionByName(ended)


def _opened() -> Column:
    """The text of a record from its brace on, if what stands before it may stand there."""
    value = F.col("value")
    fits = F.when(F.col("lead") == 0, value.rlike(_FIRST)).otherwise(value.rlike(_NEXT))
    return F.when(fits, F.regexp_replace(value, _LEAD, "")).otherwise(malformed(WHAT, F.col("file")))
