"""A bitmap over hashed keys that tells most rows without a match before they are shuffled.

A list too large to broadcast has a bitmap of fixed size that is not: the hash of every key sets one bit.
A row whose bit is not set has no match for certain. The others may have one, and go to the exact
join. A list with far more keys than bits sets them all; then every row goes to the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapweave.functions.expressions import field
from mapweave.operators.skew import temp_name

# Bits of a bitmap: 8 MB, in pieces of 4 KB.
BITS = 1 << 26
# Fixed by Spark's bitmap functions.
BUCKET = 1 << 15


def can_sift(records: DataFrame, entries: DataFrame, keys: list[tuple[str, str]]) -> bool:
    """Whether equal keys have equal hashes on both sides: their types are the same, and exact."""
    types = [(records.schema[a].dataType, entries.schema[b].dataType) for a, b in keys]
    return all(a == b and a.typeName() not in ("float", "double") for a, b in types)


def _bit(columns: list[str]) -> Column:
    return F.pmod(F.xxhash64(*map(field, columns)), F.lit(BITS))


def may_match(records: DataFrame, entries: DataFrame, keys: list[tuple[str, str]], flag: str, null_safe: bool = False) -> DataFrame:
    """``records`` with a boolean ``flag``, false only where no entry has the row's key."""
    lefts, rights = [a for a, _ in keys], [b for _, b in keys]
    listed = entries if null_safe else entries.dropna(subset=rights)
    bit, bucket, bits, own = (temp_name(n) for n in ("bit", "bucket", "bits", "bucket"))
    marked = listed.select(_bit(rights).alias(bit)).groupBy(F.expr(f"`{bit}` div {BUCKET}").alias(bucket))
    bitmap = marked.agg(F.bitmap_construct_agg(F.col(bit) % BUCKET).alias(bits))
    here = records.withColumn(bit, _bit(lefts)).withColumn(own, F.expr(f"`{bit}` div {BUCKET}"))
    # At most BITS / BUCKET rows, whatever the list.
    found = here.join(F.broadcast(bitmap), F.col(own) == F.col(bucket), "left")
    within = (F.col(bit) % BUCKET).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(within / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    is_set = F.coalesce(F.getbit(byte, within % 8) == 1, F.lit(False))
    if not null_safe:
        for name in lefts:
            is_set &= field(name).isNotNull()
    return found.withColumn(flag, is_set).drop(bit, bucket, bits, own)
