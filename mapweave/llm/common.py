"""Helpers shared by the operators: reading, staging, row numbers, permutations."""

from __future__ import annotations

import ctypes
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from mapweave.sources.storage import Staging

# Rows that one task numbers at a time; more rows only mean more buckets.
ROWS_PER_BUCKET = 50_000


def share_code(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did.

    Enough where they see the same file system; on other clusters the package is
    shipped with the job (``--py-files``).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Return what a Python worker has freed to the system; workers outlive their tasks and stay as large as they were."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def staging(df: DataFrame) -> Staging:
    """A new folder for staged tables on the session's shared storage."""
    return Staging(df.sparkSession)


def with_columns(df: DataFrame, *extra: T.StructField) -> T.StructType:
    """The schema of a row struct of ``df`` followed by ``extra`` columns."""
    return T.StructType([T.StructField("row", df.schema), *extra])


def group_key(column: str) -> Column:
    """A text key that is never null and keeps null apart from every value."""
    value = F.col(column).cast("string")
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), value))


def bucket_count(rows: int) -> int:
    """Buckets for numbering ``rows`` rows, a power of two that grows with them."""
    return 1 << max(4, (max(rows, 1) // ROWS_PER_BUCKET).bit_length())


def hash_bucket(hashed: str, buckets: int) -> Column:
    """The top bits of a 64-bit hash, in the order of the hash itself."""
    shift = 64 - (buckets.bit_length() - 1)
    return F.shiftright(F.col(hashed), shift).cast("int")


def numbered(
    df: DataFrame, group: list[str], bucket: str, order: list[str], amount: str | None = None
) -> DataFrame:
    """Add ``nth`` (from 0), ``before`` and ``total`` to rows ordered inside each group.

    ``before`` and ``total`` are sums of ``amount`` (1 where none is given) over
    the rows ahead and over the whole group. Rows order by (bucket, order); one
    task sees one bucket of one group, so a group with a third of all rows is
    spread over all its buckets. ``df`` is read twice and should be staged.
    """
    value = F.col(amount) if amount else F.lit(1).cast("long")
    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*group)
    ahead = whole.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(g).alias(f"_o_{g}") for g in group],
        F.col(bucket).alias("_o_bucket"),
        F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_nth"),
        F.sum("_sum").over(whole).alias("total"),
    )
    match = F.col(bucket) == F.col("_o_bucket")
    for g in group:
        match &= F.col(g) == F.col(f"_o_{g}")
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        df.withColumn("_n", F.row_number().over(inside))
        .withColumn("_run", F.sum(value).over(running) - value)
        .join(offsets, match)
        .withColumn("nth", F.col("_nth") + F.col("_n") - 1)
        .withColumn("before", F.col("_before") + F.col("_run"))
        .drop("_n", "_run", "_before", "_nth", "_o_bucket", *[f"_o_{g}" for g in group])
    )


def permuted(x: Column, n: Column, *salts: Column, seed: int, rounds: int = 20) -> Column:
    """A pseudorandom permutation of [0, n) applied to ``x``, for any n.

    Swap-or-not shuffle: each round pairs x with (key - x) mod n and a hash bit of
    the pair decides whether they swap, so that every round is a bijection.
    """
    size = F.greatest(n, F.lit(1)).cast("long")

    def step(acc: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(seed), r, *salts), size) - acc, size)
        chosen = F.xxhash64(F.lit(seed + 1), r, F.greatest(acc, partner), *salts)
        return F.when(chosen.bitwiseAND(F.lit(1)) == 1, partner).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), step)
