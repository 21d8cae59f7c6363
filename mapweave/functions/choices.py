r"""Choice lists of a data dictionary: ``1, Yes | 2, No``.

A list with any malformed part counts as no list at all. A part is a code of
digits and underscores, a comma and one space, and a label without ``|``; parts
are separated by ``|`` and a space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CODE = r"\s*[0-9_]+\s*, "
# A blank text is a list without choices, so it need not match.
VALID_LIST = rf"\A{_CODE}[^|]*(?:\| {_CODE}[^|]*)*+\z"
# Everything up to U+0020, as Java's trim.
_BLANKS = "".join(map(chr, range(0x21)))
# Blanks other than the space are rare, and a set of them is slow to trim.
_ODD_BLANK = r"[\x00-\x1f]"


def _trimmed(text: Column) -> Column:
    return F.when(text.rlike(_ODD_BLANK), F.btrim(text, F.lit(_BLANKS))).otherwise(F.trim(text))


def has_choices(text: Column) -> Column:
    """Whether the text is a well-formed list of at least one choice."""
    return text.rlike(VALID_LIST)


def choice_parts(text: Column) -> Column:
    """The parts of a well-formed list, as an array of strings."""
    return F.split(text, r"\|")


def choice_index(part: Column) -> Column:
    """The code of one part."""
    return _trimmed(F.substring_index(part, ",", 1))


def choice_description(part: Column) -> Column:
    return _trimmed(F.substr(part, F.instr(part, ",") + 1))
