"""Labelled training rows, held apart from the rows a model is judged on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
# Labelled rows that a model is fitted on, at most.
SAMPLE = 20_000


def is_held_out(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """Whether crc32 of the id as text is divisible by ``folds``; a null id counts as empty text."""
    name = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    return F.crc32(name.cast("binary")) % folds == 0


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE
) -> DataFrame:
    """(text, label) of at most ``sample`` labelled documents outside the held-out fold.

    The sample is the same on every run: the labels with the least hash of their id. An id
    with both labels is left out. The ids are broadcast, which ``sample`` bounds. Of several
    rows with an id, the one with the least hash of its text is taken.
    """
    known = labels.where(~is_held_out(doc_id) & F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{doc_id}`").alias("_id"))
    sure = known.agg(F.min(f"`{label}`").alias("label"), F.max(f"`{label}`").alias("_most")).where("label = _most")
    chosen = sure.orderBy(F.xxhash64("_id"), "_id").limit(sample).select("_id", F.col("label").cast("int").alias("label"))
    rows = docs.select(F.col(f"`{doc_id}`").alias("_doc"), F.col(f"`{text}`").cast("string").alias("text"))
    found = rows.join(F.broadcast(chosen), F.col("_doc") == F.col("_id"))
    one = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return found.groupBy("_id").agg(one, F.min("label").alias("label")).select("text", "label")
