"""Sharding by proportional stratified interleaving, in DataFrame functions only.

The rows of every source are put in a seeded random order and ranked. A row's
fractional rank is its place in [0, 1) within its own source. Sorting all rows
by fractional rank lays every source out evenly from start to end, so cutting
the order into equal runs gives shards that each hold the mixture. Shard sizes
differ by one row at most.

Both rankings work on buckets (by hash, then by fractional rank), so a source with a
third of all rows is ranked by many tasks and nothing is sorted in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapweave.llm import common

SHARDS = 16
SEED = 20_011
DRAWS = 1 << 30


def interleaved(rows: DataFrame, source: str, order: list[Column], shards: int, seed: int) -> DataFrame:
    """Add ``shard`` and ``slot`` (from 0 within the shard) to narrow rows.

    ``order`` names what identifies a row; rows equal in all of it are
    interchangeable. A null source is a stratum of its own.
    """
    stage = common.staging(rows)
    keyed = rows.select(
        "*", common.group_key(source).alias("_stratum"), F.xxhash64(F.lit(seed), *order).alias("_hash")
    )
    keyed = stage.table(keyed, "shard_rows")
    n = keyed.count()
    buckets = common.bucket_count(n)
    ordered = keyed.withColumn("_bucket", common.hash_bucket("_hash", buckets))
    # Hashes are signed; their order is all that matters.
    ranked = common.numbered(ordered, ["_stratum"], "_bucket", ["_hash", *rows.columns])
    # Where a row lies between its rank and the next is drawn, so that sources of few rows, which
    # all have the same ranks, spread over all cells.
    drawn = (F.pmod(F.xxhash64(F.lit(seed + 1), "_hash", "_stratum"), F.lit(DRAWS)) + 0.5) / DRAWS
    place = (F.col("nth") + drawn) / F.col("total")
    placed = ranked.select(
        *rows.columns, "_stratum", "_hash", place.alias("_place"), F.floor(place * buckets).cast("int").alias("_cell")
    )
    placed = stage.table(placed, "shard_places").withColumn("_all", F.lit(0))
    ordering = ["_place", "_stratum", "_hash", *rows.columns]
    position = common.numbered(placed, ["_all"], "_cell", ordering)
    total = F.lit(n).cast("long")
    shard = F.expr(f"cast(nth * {shards} div {max(n, 1)} AS int)")
    first = F.ceil(shard * total / F.lit(shards)).cast("long")
    return position.select(*rows.columns, shard.alias("shard"), (F.col("nth") - first).alias("slot"))


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per document: doc_id, source, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the number of UTF-8 bytes of the text plus 1 (null text: 1, and the checksum of
    no bytes). The law is ``rows``: shard sizes differ by one at most, slots have
    no gap, and another shard count deals anew, so ``grown_shard`` is null. Rows
    with equal ids order by checksum, size and source; equal rows are
    interchangeable. Fewer rows than shards leave shards empty; no rows give none.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    order = [F.col(c) for c in ("doc_id", "text_crc32", "size")]
    return interleaved(narrow, "source", order, shards, seed).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder ``shard=N`` per shard, each sorted by slot within its files."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
