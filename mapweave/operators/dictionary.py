"""Code/label rows out of a data dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave import fixed_values as fixed
from mapweave.functions.choices import (
    choice_description,
    choice_index,
    choice_parts,
    has_choices,
)
from mapweave.functions.expressions import field
from mapweave.operators.skew import balanced_join, temp_name


def explode_choices(
    entries: DataFrame, list_column: str, index_column: str = "index", label_column: str = "description"
) -> DataFrame:
    """One row per choice; an entry whose list has a malformed part gives none."""
    part = temp_name("part")
    kept = [field(c) for c in entries.columns if c != list_column]
    return (
        entries.where(has_choices(field(list_column)))
        .select(*kept, F.explode(choice_parts(field(list_column))).alias(part))
        .select(
            *kept,
            choice_index(F.col(part)).alias(index_column),
            choice_description(F.col(part)).alias(label_column),
        )
    )


def member_rows(
    dictionary: DataFrame,
    pattern: str = fixed.MEMBER_PATTERN,
    index_start: int = fixed.MEMBER_INDEX_START,
    field_name: str = fixed.MEMBER_FIELD,
    table: str = fixed.MEMBER_TABLE,
    column: str = fixed.MEMBER_COLUMN,
) -> DataFrame:
    """Label rows of a numbered family of fields; the number is the tail of the name."""
    name = F.col("field_name")
    return dictionary.where(name.rlike(pattern)).select(
        F.lit(field_name).alias("field_name"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.substr(name, F.lit(index_start)).alias("index"),
        F.col("field_label").alias("description"),
    )


def mapped_choices(dictionary: DataFrame, rules: DataFrame) -> DataFrame:
    """Choices of dictionary fields that are the first source of a rule, once per rule."""
    source = temp_name("source")
    # Lists are taken apart before the join, so each is read once.
    choices = explode_choices(
        dictionary.select("field_name", "select_choices_or_calculations"),
        "select_choices_or_calculations",
    )
    first_sources = rules.select(
        F.try_element_at("sources", F.lit(1)).alias(source), "table", "column"
    )
    return balanced_join(first_sources, choices, [(source, "field_name")], "inner").drop(source)


def label_dimension(dictionary: DataFrame, rules: DataFrame, **members) -> DataFrame:
    """The dimension that decodes checkbox values: table, column, index, description, id."""
    choices = mapped_choices(dictionary, rules)
    rows = choices.unionByName(member_rows(dictionary, **members))
    code = F.concat(F.col("field_name"), F.lit(fixed.CHECKBOX_SEPARATOR), F.col("index"))
    return rows.select("table", "column", "index", "description", code.alias("id"))
