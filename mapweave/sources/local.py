"""Small driver-side rows as DataFrames."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Rows as a local relation, whose exact size Catalyst knows."""
    fields = to_arrow_schema(schema)
    columns = [pa.array([row[i] for row in rows], f.type) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=fields))
