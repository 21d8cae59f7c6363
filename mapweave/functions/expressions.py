"""The expression operators of mapping rules, as Column helpers.

``types`` arguments give the operand types. They are needed because ANSI mode
would cast text to the type of a number next to it and fail on bad text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.functions.casts import comparable, compared_as_text
from mapweave.functions.person_names import first_name, last_name

__all__ = [
    "field",
    "literal",
    "first_nonblank",
    "equals",
    "if_else",
    "first_name",
    "last_name",
]

STRING = T.StringType()


def field(name: str) -> Column:
    """A column by its exact name."""
    return F.col(f"`{name}`")


def literal(text: str) -> Column:
    return F.lit(text)


def _same_type(values: list[Column], types: list[T.DataType]) -> list[Column]:
    """Branches of one result: mixed with text they all become text."""
    if len(set(types)) > 1 and STRING in types:
        return [v.cast("string") for v in values]
    return values


def common_type(types: list[T.DataType]) -> T.DataType:
    """The type of a value that is one of several: text if any is, else the widest."""
    if len(set(types)) == 1:
        return types[0]
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType]
    if STRING in types or not all(type(t) in order for t in types):
        return STRING
    return max(types, key=lambda t: order.index(type(t)))


def first_nonblank(values: list[Column], types: list[T.DataType]) -> Column:
    """The first value that is neither null nor "", or else the last value."""
    branches = _same_type(values, types)
    heads = [
        F.nullif(b, F.lit("")) if t == STRING else b
        for b, t in zip(branches[:-1], types[:-1], strict=True)
    ]
    return F.coalesce(*heads, branches[-1])


def equals(left: Column, right: Column, left_type: T.DataType, right_type: T.DataType) -> Column:
    """SQL equality; text next to another type is compared as described in casts."""
    if left_type != right_type:
        if right_type == STRING:
            if compared_as_text(left_type):
                return left.cast("string") == right
            return left == comparable(right, left_type)
        if left_type == STRING:
            return equals(right, left, right_type, left_type)
    return left == right


def if_else(
    condition: Column, then: Column, other: Column, then_type: T.DataType, other_type: T.DataType
) -> Column:
    """``then`` where the condition is true, ``other`` where it is false or null."""
    then, other = _same_type([then, other], [then_type, other_type])
    return F.when(condition, then).otherwise(other)
