r"""First and last names out of free-form person names.

A name is parsed by one regular expression replacement that turns it into
``<first>MARK<last>`` and leaves it alone when it does not parse. In that case a
piece of the name is tried in the same way, and when that does not parse either
the last name is the whole input.

Groups are atomic where the name format does not go back on a choice: in
``Mary Smith PhD`` the letters ``Ph`` are taken as a last name, so the name does
not parse, while ``Mary Smith, PhD`` does.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapweave.fixed_values import (
    NAME_CUT_AFTER,
    NAME_CUTS_BEFORE,
    NAME_TITLES,
    WHOLE_NAMES,
)

# A private-use character no name holds.
MARK = "\ue000"

_WORD = r"(?>[a-zA-Z]+[a-z]+)"
_NAME = f"(?>{_WORD}(?:-{_WORD})?)"
_FIRST = rf"(?>{_NAME}|[a-zA-Z]\.?+)"
_MIDDLE = rf"(?>\({_NAME}\)|{_FIRST})"
_PREFIXES = r"(?>(?:Dr\. )*+)"
_TITLES = "(?:,? (?:" + "|".join(re.escape(t) for t in NAME_TITLES) + "))*+"
# Groups: a whole name, then first, last, first, last, last, first, last. A name
# starting with one of the whole names is that name or does not parse.
_NAME_PATTERN = (
    rf"\A(?>({'|'.join(WHOLE_NAMES)})|{_PREFIXES}(?>({_FIRST}) {_MIDDLE} ({_NAME})"
    rf"|({_FIRST}) ({_NAME})|({_NAME}), ({_FIRST})|({_NAME})){_TITLES} ?+)\z"
)
_PARTS = f"$1$2$4$7{MARK}$1$3$5$6$8"

# Java's trim: everything up to U+0020.
_BLANKS = "".join(map(chr, range(0x21)))

WELL_FORMED_FIRST = rf"\A{_FIRST}\z"
WELL_FORMED_LAST = rf"\A{_NAME}\z"


def _piece(name: Column) -> Column:
    """The part to try when the whole name does not parse; null for none."""
    after = F.substring_index(F.substring_index(name, NAME_CUT_AFTER, 2), NAME_CUT_AFTER, -1)
    piece = F.when(name.contains(NAME_CUT_AFTER), after)
    for cut in NAME_CUTS_BEFORE:
        piece = piece.when(name.contains(cut), F.substring_index(name, cut, 1))
    return F.btrim(piece, F.lit(_BLANKS))


def _parse(name: Column) -> tuple[Column, Column]:
    """The name with its parts marked, and whether it parsed.

    The condition reads the marked name twice, which makes Spark keep it for the
    branch that returns it.
    """
    marked = F.regexp_replace(name, _NAME_PATTERN, _PARTS)
    return marked, (F.substring_index(marked, MARK, 1) != marked) & ~name.contains(MARK)


def _parts(name: Column) -> Column:
    whole, whole_parsed = _parse(name)
    piece, piece_parsed = _parse(_piece(name))
    return (
        F.when(whole_parsed, whole)
        .when(piece_parsed, piece)
        .otherwise(F.concat(F.lit(MARK), name))
    )


def first_name(name: Column) -> Column:
    """The first name, or null where there is none."""
    first = F.substring_index(_parts(name), MARK, 1)
    # Blank to null without a condition, so that the parts are worked out once,
    # also together with last_name.
    return F.try_element_at(F.array_remove(F.array(first), ""), F.lit(1))


def last_name(name: Column) -> Column:
    """The last name; the whole input where no name can be read."""
    parts = _parts(name)
    return F.substr(parts, F.locate(MARK, parts) + 1)


def is_well_formed_first(name: Column) -> Column:
    return name.rlike(WELL_FORMED_FIRST)


def is_well_formed_last(name: Column) -> Column:
    return name.rlike(WELL_FORMED_LAST)
