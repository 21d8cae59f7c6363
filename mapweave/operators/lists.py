"""Enrich, restrict and block records by list files.

Lists are all text. A list column meets a typed record column by value for
numbers and booleans and by text for dates, and never fails on bad text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.functions.casts import comparable, compared_as_text
from mapweave.functions.expressions import field
from mapweave.operators.filters import Stage
from mapweave.operators.sift import can_sift, may_match
from mapweave.operators.skew import balanced_join, heavy_keys, key_condition, temp_name, will_broadcast


def _prepared(
    records: DataFrame, entries: DataFrame, shared: list[str]
) -> tuple[DataFrame, DataFrame, list[tuple[str, str]]]:
    """Records and entries with key columns that can be compared, and the key pairs."""
    keys, as_text, entry_columns = [], {}, []
    for name in entries.columns:
        if name not in shared:
            entry_columns.append(field(name))
            continue
        record_type, record_key, entry_key = records.schema[name].dataType, name, temp_name("entry")
        value = field(name)
        if entries.schema[name].dataType.typeName() == "string":
            if compared_as_text(record_type):
                record_key = temp_name("text")
                as_text[record_key] = field(name).cast("string")
            else:
                value = comparable(value, record_type)
        entry_columns.append(value.alias(entry_key))
        keys.append((record_key, entry_key))
    return records.withColumns(as_text) if as_text else records, entries.select(*entry_columns), keys


def _shared(records: DataFrame, entries: DataFrame) -> list[str]:
    shared = [c for c in entries.columns if c in records.columns]
    if not shared:
        raise ValueError(f"list with columns {entries.columns} shares no column with the records")
    return shared


def _check_block(records: DataFrame, entries: DataFrame) -> None:
    missing = [c for c in entries.columns if c not in records.columns]
    if missing or not entries.columns:
        raise ValueError(f"block list columns {entries.columns}: records lack {missing or 'them all'}")


def _join_list(records: DataFrame, entries: DataFrame, how: str) -> DataFrame:
    shared = _shared(records, entries)
    left, right, keys = _prepared(records, entries, shared)
    joined = balanced_join(left, right, keys, how)
    added = [c for c in entries.columns if c not in shared]
    return joined.select(*[field(c) for c in records.columns + added])


def enrich(records: DataFrame, entries: DataFrame) -> DataFrame:
    """Left join on all shared column names; adds the other list columns.

    A key listed twice multiplies its records.
    """
    return _join_list(records, entries, "left")


def restrict(records: DataFrame, entries: DataFrame) -> DataFrame:
    """Inner join on all shared column names: keeps listed records only."""
    return _join_list(records, entries, "inner")


def block(records: DataFrame, entries: DataFrame) -> DataFrame:
    """Drop records equal to any entry on all list columns; null equals null."""
    _check_block(records, entries)
    left, right, keys = _prepared(records, entries.distinct(), entries.columns)
    kept = balanced_join(left, right, keys, "left_anti", null_safe=True)
    return kept.select(*[field(c) for c in records.columns])


# How records meet a list: straight away, past a bitmap, or where they lie already.
WAYS = DIRECT, SIFTED, PLACED = "direct", "sifted", "placed"


def _matched(
    records: DataFrame, entries: DataFrame, alive: str, match: str, way: str, null_safe: bool = False, unique: bool = False
) -> DataFrame:
    """Left join of the rows alive, with ``match`` true where an entry was found.

    The other rows meet no entry and stay as they are, once each. ``way`` is one of WAYS: with SIFTED,
    rows that have no match for certain pass by the join too, and ``records``, which is read
    twice, should be staged. With PLACED the join is a plain one, so that records which an earlier join
    on the same key has placed are not shuffled again.
    """
    shared = _shared(records, entries)
    left, right, keys = _prepared(records, entries, shared)
    living, maybe = temp_name("living"), temp_name("maybe")
    marked = right.withColumns({living: F.lit(True), match: F.lit(True)})
    added = [c for c in entries.columns if c not in shared]
    columns = [field(c) for c in records.columns + added + [match]]
    if way == PLACED:
        marked = marked.drop(living)
        return left.join(marked, key_condition(keys, null_safe) & F.col(alive), "left").select(*columns)
    if way == DIRECT or not can_sift(left, right, keys):
        return balanced_join(left, marked, [*keys, (alive, living)], "left", null_safe, unique).select(*columns)
    told = may_match(left, right, keys, maybe, null_safe)
    going = F.col(alive) & F.col(maybe)
    joined = balanced_join(told.where(going).drop(maybe), marked, keys, "left", null_safe, unique).select(*columns)
    rest = told.where(~going).select(*[field(c) for c in records.columns])
    return joined.unionByName(rest, allowMissingColumns=True)


def mark_enriched(records: DataFrame, entries: DataFrame, alive: str, way: str = DIRECT) -> DataFrame:
    """``enrich`` for the rows alive."""
    match = temp_name("match")
    return _matched(records, entries, alive, match, way).drop(match)


def mark_restricted(records: DataFrame, entries: DataFrame, alive: str, way: str = DIRECT) -> DataFrame:
    """``restrict`` that keeps unlisted rows, no longer alive."""
    match = temp_name("match")
    joined = _matched(records, entries, alive, match, way)
    return joined.withColumn(alive, F.col(alive) & F.col(match).isNotNull()).drop(match)


def mark_blocked(records: DataFrame, entries: DataFrame, alive: str, way: str = DIRECT) -> DataFrame:
    """``block`` that keeps the blocked rows, no longer alive."""
    _check_block(records, entries)
    match = temp_name("match")
    joined = _matched(records, entries.distinct(), alive, match, way, null_safe=True, unique=True)
    return joined.withColumn(alive, F.col(alive) & F.col(match).isNull()).drop(match)


# Writes a DataFrame to shared storage and reads it back, to cut its lineage.
Cut = Callable[[DataFrame], DataFrame]


def _on_one_key(records: DataFrame, lists: list[DataFrame]) -> list[DataFrame]:
    """The first lists, all too large to broadcast, that share one key with the records and what they add."""
    columns, group = set(records.columns), []
    for entries in lists:
        shared = columns & set(entries.columns)
        if will_broadcast(entries) or (group and shared != key):
            break
        key = shared
        group.append(entries)
        columns |= set(entries.columns)
    return group


def _have_heavy_keys(records: DataFrame, group: list[DataFrame]) -> bool:
    """Whether a key of the records, or of one of the lists, has more rows than one task should get."""
    for n, entries in enumerate(group):
        left, right, keys = _prepared(records, entries, _shared(records, entries))
        sides = [(right, [b for _, b in keys])] + ([(left, [a for a, _ in keys])] if n == 0 else [])
        if any(heavy_keys(side, names, temp_name("n")) is not None for side, names in sides):
            return True
    return False


def _stage(operator, marking, lists: Iterable[DataFrame], cut: Cut | None, rejects: bool = True) -> Stage:
    lists = list(lists)

    def placed(records: DataFrame, entries: DataFrame) -> DataFrame:
        # A list too large to broadcast has the records read twice, once to
        # count their keys. From a written table that reads the keys alone.
        return cut(records) if cut is not None and not will_broadcast(entries) else records

    def keep(records: DataFrame) -> DataFrame | None:
        if rejects and not all(map(will_broadcast, lists)):
            # Kept and rejected rows share the work on a large list.
            return None
        for entries in lists:
            records = operator(placed(records, entries), entries)
        return records

    def mark(records: DataFrame, alive: str) -> DataFrame:
        at = 0
        while at < len(lists):
            large = cut is not None and not will_broadcast(lists[at])
            group = _on_one_key(records, lists[at:]) if large else lists[at : at + 1]
            records = placed(records, group[0])
            if len(group) > 1 and not _have_heavy_keys(records, group):
                for entries in group:
                    records = marking(records, entries, alive, PLACED)
            else:
                group = group[:1]
                records = marking(records, group[0], alive, SIFTED if large else DIRECT)
            at += len(group)
        return records

    return Stage(mark, keep, rejects)


def enrich_all(lists: Iterable[DataFrame], cut: Cut | None = None) -> Stage:
    """Enrich by one list after another; later lists may use columns of earlier ones."""
    return _stage(enrich, mark_enriched, lists, cut, rejects=False)


def restrict_all(lists: Iterable[DataFrame], cut: Cut | None = None) -> Stage:
    return _stage(restrict, mark_restricted, lists, cut)


def block_all(lists: Iterable[DataFrame], cut: Cut | None = None) -> Stage:
    return _stage(block, mark_blocked, lists, cut)
