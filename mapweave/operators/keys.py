"""Surrogate keys: dense, repeatable ids for distinct key tuples.

Ids need no global sort. They follow the MD5 of the key tuples, then the tuples.
Tuples fall into buckets by the first hex digits of the MD5, each bucket is
numbered on its own, and the running totals of the bucket sizes shift each bucket
into place. The number of buckets says only how much one task sorts: the same
keys get the same ids whatever it is, and whatever the partitioning, so a
recomputed task agrees with the one it replaces.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapweave.functions.expressions import field
from mapweave.operators.skew import balanced_join, temp_name

BUCKET_DIGITS = 3
KEYS_PER_BUCKET = 250_000
_UNIT_SEPARATOR = chr(31)


def digits_for(count: int) -> int:
    """Hex digits that cut so many tuples into buckets one task can sort."""
    digits = BUCKET_DIGITS
    while count > KEYS_PER_BUCKET * 16**digits:
        digits += 1
    return digits


def number_keys(keys: DataFrame, id_column: str, digits: int = BUCKET_DIGITS) -> DataFrame:
    """Number the distinct tuples of ``keys`` from 0; tuples with a null get no id."""
    bucket, size, offset, rank, group = (temp_name(n) for n in ("bucket", "size", "offset", "rank", "group"))
    full, inside, own = temp_name("code"), temp_name("inside"), temp_name("bucket")
    columns = [field(c) for c in keys.columns]
    code = F.md5(F.concat_ws(_UNIT_SEPARATOR, *[c.cast("string") for c in columns]))
    tuples = (
        keys.where(reduce(and_, [c.isNotNull() for c in columns]))
        .distinct()
        .withColumn(full, code)
        .withColumn(bucket, F.substring(full, 1, digits))
    )
    ahead = (Window.unboundedPreceding, -1)
    # Two levels of running totals: of groups of buckets by their first digits, and inside each.
    sizes = tuples.groupBy(bucket).agg(F.count(F.lit(1)).alias(size))
    sizes = sizes.withColumn(group, F.substring(bucket, 1, BUCKET_DIGITS))
    groups = sizes.groupBy(group).agg(F.sum(size).alias(size))
    before = F.coalesce(F.sum(size).over(Window.orderBy(group).rowsBetween(*ahead)), F.lit(0))
    within = F.coalesce(F.sum(size).over(Window.partitionBy(group).orderBy(bucket).rowsBetween(*ahead)), F.lit(0))
    offsets = (
        sizes.select(F.col(bucket).alias(own), group, within.alias(inside))
        .join(groups.select(group, before.alias(offset)), group)
        .select(own, (F.col(offset) + F.col(inside)).alias(offset))
    )
    in_bucket = Window.partitionBy(bucket).orderBy(full, *columns)
    return (
        tuples.withColumn(rank, F.row_number().over(in_bucket))
        .join(offsets, F.col(bucket) == F.col(own))
        .select(*columns, (F.col(offset) + F.col(rank) - 1).alias(id_column))
    )


def key_tuples(records: DataFrame, parts: list[Column]) -> DataFrame:
    """One row per record with the evaluated key parts, named by position."""
    return records.select(*[p.alias(f"part{i}") for i, p in enumerate(parts)])


def attach_keys(
    records: DataFrame, parts: list[Column], numbered: DataFrame, id_columns: list[str]
) -> DataFrame:
    """Add the ids of a numbered key table; a null key part gives a null id.

    ``numbered`` has the key parts followed by the id. Several id columns may
    be filled from one key table.
    """
    names = [temp_name("part") for _ in parts]
    entries = [temp_name("key") for _ in parts]
    *part_columns, id_column = numbered.columns
    left = records.withColumns(dict(zip(names, parts, strict=True)))
    right = numbered.select(
        *[field(p).alias(e) for p, e in zip(part_columns, entries, strict=True)],
        *[field(id_column).alias(c) for c in id_columns],
    )
    joined = balanced_join(left, right, list(zip(names, entries)), "left", unique_right=True)
    return joined.drop(*names, *entries)


def generate_ids(
    records: DataFrame, parts: list[Column], id_column: str, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Number the distinct key tuples and attach the ids in one go."""
    numbered = number_keys(key_tuples(records, parts), temp_name("id"), digits)
    return attach_keys(records, parts, numbered, [id_column])
