"""The corpus pipeline: from raw documents to token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to shared storage and reads it back for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mapweave.llm import common, decontaminate, mixing, quality, simhash, token_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.good_documents(docs, common.table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    common.share_code(spark)
    return simhash.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of the benchmark than the limit; the others go."""
    return decontaminate.decontaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of the mixture: a row for each pass that takes words of a document."""
    common.share_code(spark)
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: doc_id, start, n_tokens, ids_crc32."""
    common.share_code(spark)
    path = common.staging(docs).folder("tokens")
    token_file.write_tokens(docs, path)
    return token_file.read_tokens(spark, path)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("token-ID / binary output", token_output),
]

# Fingerprints, learned weights and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    docs = common.table(spark, sf_dir, "documents")
    stage = common.staging(docs)
    for number, (_, function) in enumerate(STAGES):
        docs = stage.table(function(spark, docs, sf_dir), f"stage_{number}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
