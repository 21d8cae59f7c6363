"""Surrogate keys that stay over several runs.

A registry is a folder with a table of (key parts, id) for every set of key parts. Keys that it knows keep
their ids; new ones follow the highest id, in the order that ``number_keys`` gives them, so ids are
dense whatever the runs. Each run that meets new keys adds a table of them alone; the file
``CURRENT`` lists the tables that count, so a broken run adds nothing, and a repeated one
finds its keys.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.functions.expressions import field
from mapweave.operators.keys import digits_for, number_keys
from mapweave.operators.skew import key_condition, temp_name
from mapweave.sources.publish import CURRENT, read_file, replace_file

ID = "id"
# Tables of one registry after which they are written as one.
TABLES = 32


class KeyRegistry:
    """The keys of one folder. One run at a time may add keys."""

    def __init__(self, spark: SparkSession, directory: str):
        self._spark = spark
        self.directory = directory

    def folder(self, parts: Iterable[str]) -> str:
        """Where keys of these parts lie; parts are told apart by their text and order."""
        name = hashlib.md5(json.dumps(list(parts)).encode()).hexdigest()
        return f"{self.directory}/{name}"

    def known(self, parts: Iterable[str]) -> DataFrame | None:
        """All keys of these parts with their ids, or None before the first run."""
        folder = self.folder(parts)
        tables = (read_file(self._spark, f"{folder}/{CURRENT}") or "").split()
        return self._spark.read.parquet(*[f"{folder}/{t}" for t in tables]) if tables else None

    def numbered(self, parts: Iterable[str], keys: DataFrame) -> DataFrame:
        """The distinct tuples of ``keys`` with their ids, new ones registered; a null part gives none.

        ``keys`` is read several times and should be staged.
        """
        parts = list(parts)
        columns = keys.columns
        known = self.known(parts)
        if known is None:
            self._add(parts, number_keys(keys, ID, digits_for(keys.count())))
            return self.known(parts)
        told = [(f.name, f.dataType) for f in known.schema if f.name != ID]
        if told != [(f.name, f.dataType) for f in keys.schema]:
            raise ValueError(f"keys of {parts} were registered as {told}")
        other = {c: temp_name("known") for c in columns}
        named = known.select(*[field(c).alias(other[c]) for c in columns], field(ID))
        match = key_condition([(c, other[c]) for c in columns], null_safe=False)
        new = keys.dropna().distinct().join(named, match, "left_anti")
        count = new.count()
        if count:
            highest = known.agg(F.max(ID)).first()[0]
            fresh = number_keys(new, ID, digits_for(count))
            self._add(parts, fresh.withColumn(ID, field(ID) + (0 if highest is None else highest + 1)))
            known = self.known(parts)
        # Only the keys of this run are joined to its records.
        mine = keys.dropna().distinct().select(*[field(c).alias(other[c]) for c in columns])
        return known.join(mine, match, "left_semi").select(*columns, ID)

    def _add(self, parts: list[str], table: DataFrame) -> None:
        folder, name = self.folder(parts), uuid4().hex
        before = (read_file(self._spark, f"{folder}/{CURRENT}") or "").split()
        if len(before) >= TABLES:
            # The tables so far become one; they stay, unlisted, for runs that still read them.
            table, before = self.known(parts).unionByName(table), []
        table.write.parquet(f"{folder}/{name}")
        replace_file(self._spark, f"{folder}/{CURRENT}", "\n".join([*before, name]))
