"""Differences between what the data has and what the rules use, and row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` minus rows of ``right``, each copy taken off once."""
    return left.exceptAll(right)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not have."""
    return left.subtract(right)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs; read it with ``observation.get["rows"]``."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
