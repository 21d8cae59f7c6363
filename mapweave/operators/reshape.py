"""Wide to long: checkbox groups and prefixed columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.fixed_values import CHECKBOX_SEPARATOR, TICKED
from mapweave.functions.expressions import field
from mapweave.operators.skew import balanced_join, temp_name


def checkbox_groups(columns: list[str]) -> dict[str, list[str]]:
    """Checkbox columns by field: those sharing the text before the separator."""
    groups: dict[str, list[str]] = {}
    for column in columns:
        prefix, found, _ = column.partition(CHECKBOX_SEPARATOR)
        if found:
            groups.setdefault(prefix, []).append(column)
    return groups


def plain_columns(columns: list[str]) -> list[str]:
    """Columns that belong to no checkbox group."""
    return [c for c in columns if CHECKBOX_SEPARATOR not in c]


def unpivot_ticks(
    records: DataFrame, keys: list[tuple[str, str]], flags: list[str], value_column: str
) -> DataFrame:
    """One row per ticked flag of each distinct (keys, flags) row.

    ``keys`` pairs source columns with target names; the value is the name of
    the ticked column. The result is a bag: rows that differ only in other
    flags each give their ticks.
    """
    names = [temp_name("key") for _ in keys]
    value = temp_name("value")
    ticked = reduce(or_, [field(f).cast("string") == TICKED for f in flags])
    return (
        records.where(ticked)
        .select(
            *[field(source).alias(n) for (source, _), n in zip(keys, names)],
            *[field(f).cast("string").alias(f) for f in flags],
        )
        .distinct()
        .unpivot(names, [field(f) for f in flags], value_column, value)
        .where(F.col(value) == TICKED)
        .select(*[F.col(n).alias(target) for (_, target), n in zip(keys, names)], field(value_column))
    )


def attach_copied(ticks: DataFrame, copied: DataFrame, keys: list[str]) -> DataFrame:
    """Join ticks to the copied table on the key columns; entities without ticks go."""
    names = {k: temp_name("key") for k in keys}
    others = [c for c in copied.columns if c not in names]
    # Copied rows are distinct, so a key with many of them splits evenly.
    joined = balanced_join(
        copied.withColumnsRenamed(names), ticks, [(n, k) for k, n in names.items()], "inner"
    )
    return joined.select(*[field(c) for c in ticks.columns + others])


def prefixed_to_long(
    records: DataFrame, prefix: str, value_column: str, label_column: str
) -> DataFrame | None:
    """Distinct non-blank values of each prefixed column, labelled by the rest of its name.

    None when no column has the prefix.
    """
    columns = [c for c in records.columns if c.startswith(prefix)]
    if not columns:
        return None
    name = temp_name("name")
    return (
        records.select(*[field(c).cast("string").alias(c) for c in columns])
        .unpivot([], [field(c) for c in columns], name, value_column)
        .where(field(value_column) != "")
        .select(
            field(value_column),
            F.substring(F.col(name), len(prefix) + 1, max(map(len, columns))).alias(label_column),
        )
        .distinct()
    )
