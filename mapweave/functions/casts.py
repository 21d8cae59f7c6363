"""Casts to the types a mapping rule can declare.

ANSI mode is on by default in Spark 4 and a plain cast of ``""`` fails the
task, so every cast here turns bad text into null instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared types a mapping rule may use.
DECLARED_TYPES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "text": T.StringType(),
}

# Spellings of booleans, in any case.
TRUE_TEXTS = ("t", "true", "y", "yes", "1")
FALSE_TEXTS = ("f", "false", "n", "no", "0")

# Whole numbers, with a decimal tail that is cut off. Text of any other form is
# never handed to a cast: a failing try_cast costs an exception per row.
_INT_TEXT = r"\A[\x00-\x20]*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]*)[\x00-\x20]*\z"


# The same for numbers with a fraction.
_NUMBER_TEXT = (
    r"(?i)\A[\x00-\x20]*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?[fd]?|inf(?:inity)?|nan)[\x00-\x20]*\z"
)
_BLANK_AROUND = r"\A[\x00-\x20]|[\x00-\x20]\z"
_BLANKS = "".join(map(chr, range(0x21)))


def declared_type(name: str | None) -> T.DataType:
    """The Spark type for a declared type name; anything else is an error."""
    if name not in DECLARED_TYPES:
        raise ValueError(f"unsupported type {name!r}, expected one of {tuple(DECLARED_TYPES)}")
    return DECLARED_TYPES[name]


def cast_declared(value: Column, name: str | None) -> Column:
    """Cast text to a declared type; text that does not fit becomes null."""
    target = declared_type(name)
    text = value.cast("string")
    if name == "text":
        return text
    if name == "int":
        return _whole_number(text, target)
    if name == "boolean":
        return _truth(text)
    return text.try_cast(target)


def _truth(text: Column) -> Column:
    """A boolean by its spelling, with blanks around it left out."""
    plain = F.when(text.rlike(_BLANK_AROUND), F.btrim(text, F.lit(_BLANKS))).otherwise(text)
    spelled = F.lower(plain)
    return F.when(spelled.isin(*TRUE_TEXTS), True).when(spelled.isin(*FALSE_TEXTS), False)


def _whole_number(text: Column, target: T.DataType) -> Column:
    """The number before the decimal point; none there counts as 0."""
    whole = F.trim(F.substring_index(text, ".", 1))
    number = F.when(whole.isin("", "+", "-"), F.lit(0).cast(target)).otherwise(whole.try_cast(target))
    return F.when(text.rlike(_INT_TEXT), number)


def comparable(text: Column, other: T.DataType) -> Column:
    """Text made comparable with a column of type ``other``.

    Numbers and booleans compare by value, so the text is cast. Dates compare
    as text (see ``compared_as_text``) and strings need nothing.
    """
    if isinstance(other, T.BooleanType):
        return cast_declared(text, "boolean")
    if isinstance(other, T.IntegralType):
        return _whole_number(text, other)
    if isinstance(other, T.NumericType):
        return F.when(text.rlike(_NUMBER_TEXT), text.try_cast(other))
    return text


def compared_as_text(data_type: T.DataType) -> bool:
    """Whether a column of this type is turned to text before it meets text."""
    return isinstance(data_type, (T.DateType, T.TimestampType))
