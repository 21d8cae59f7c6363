"""SentencePiece ids of whole texts, and texts of ids.

The model's pieces, their order and their splits are worked out once and broadcast; their size is
bounded by the vocabulary. Texts are encoded where they are, nothing is shuffled, and what a
task remembers is bounded and goes with the task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.llm import common
from mapweave.llm.piece_model import PieceDecoder, PieceEncoder, PieceModel

END_ID = 2
# Texts encoded at a time, and characters after which a batch is cut before that.
TEXTS, CHARACTERS = 256, 2_000_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(model: str | None = None) -> PieceModel:
    with open(model or default_model(), "rb") as file:
        return PieceModel(file.read())


def _parts(lengths: list[int]):
    """(from, to) of consecutive rows that make a bounded batch."""
    start = size = 0
    for n, length in enumerate(lengths):
        if n > start and (n - start >= TEXTS or size + length > CHARACTERS):
            yield start, n
            start = n
            size = 0
        size += length
    if start < len(lengths):
        yield start, len(lengths)


def encoded(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    model: str | None = None,
    end_id: int | None = END_ID,
    decode: bool = False,
) -> DataFrame:
    """(row, ids[, decoded]) of every row: the ids of its whole text, then ``end_id``.

    ``row`` holds the columns ``keep`` (all where none are given), so no name clashes. A null
    text is an empty one and has the end id alone; rows that repeat are encoded each; an empty
    table gives an empty one. With ``decode`` the ids are also turned back into text. ``model``
    is a SentencePiece file of merge type with bytes for unknown characters.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_model(model))
    kept = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    names = [f"`{c}`" for c in (docs.columns if keep is None else keep)]
    rows = docs.select(F.struct(*names).alias("row") if names else F.lit(None).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    more = [T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    if decode:
        more.append(T.StructField("decoded", T.StringType()))

    def run(batches):
        encoder, decoder = PieceEncoder(shared.value), PieceDecoder(shared.value)
        end = np.array([] if end_id is None else [end_id], np.int32)
        for batch in batches:
            column = batch.column(1)
            lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
            for a, b in _parts(lengths):
                found = [np.append(ids, end) for ids in encoder.encode(column.slice(a, b - a).to_pylist())]
                offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
                flat = np.concatenate(found)
                out = [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]
                if decode:
                    out.append(pa.array([decoder.decode(ids.tolist()) for ids in found], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["row", "ids", "decoded"][: len(out)])

    return rows.mapInArrow(run, common.with_columns(kept, *more))


def decoded(rows: DataFrame, ids: str = "ids", into: str = "text", model: str | None = None) -> DataFrame:
    """(row, ``into``): the text of every array of ids, as the library's ``decode`` gives it.

    A null array gives null, null ids in an array are left out; ids outside the model end the job.
    """
    shared = rows.sparkSession.sparkContext.broadcast(read_model(model))
    listed = rows.select(F.struct(*[f"`{c}`" for c in rows.columns]).alias("row"), F.col(f"`{ids}`").cast("array<int>").alias("ids"))

    def run(batches):
        decoder = PieceDecoder(shared.value)
        size = len(decoder.bytes)
        for batch in batches:
            for a in range(0, batch.num_rows, TEXTS):
                texts = []
                for found in batch.column(1).slice(a, TEXTS).to_pylist():
                    given = None if found is None else [i for i in found if i is not None]
                    if given and not 0 <= min(given) <= max(given) < size:
                        raise ValueError(f"ids must lie between 0 and {size - 1}")
                    texts.append(None if given is None else decoder.decode(given))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, TEXTS), pa.array(texts, pa.string())], names=["row", into])

    return listed.mapInArrow(run, common.with_columns(rows, T.StructField(into, T.StringType())))
