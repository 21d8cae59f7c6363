"""Record filters and the chain that runs them.

A stage marks the rows it rejects. Called on records, it returns the kept rows and, if it
rejects any, the rejected ones. A chain that may stage tables marks the rows of all stages in one
pass and writes them once: what is kept and what each stage rejected are read from there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from mapweave.functions.expressions import field
from mapweave.functions.person_names import is_well_formed_first, is_well_formed_last
from mapweave.operators.skew import temp_name


class Filtered(NamedTuple):
    kept: DataFrame
    rejected: DataFrame | None


@dataclass(frozen=True)
class Stage:
    """``mark(records, alive)`` clears the boolean column ``alive`` on rows the stage rejects.

    Rows that are not alive pass through as they are. ``keep`` gives the kept rows alone, or None
    where that has no better plan. A stage that never rejects only adds columns or rows.
    """

    mark: Callable[[DataFrame, str], DataFrame]
    keep: Callable[[DataFrame], DataFrame | None]
    rejects: bool = True

    def __call__(self, records: DataFrame) -> Filtered:
        kept = self.keep(records)
        if kept is not None and not self.rejects:
            return Filtered(kept, None)
        alive = temp_name("alive")
        marked = self.mark(records.withColumn(alive, F.lit(True)), alive)
        if kept is None:
            kept = marked.where(F.col(alive)).drop(alive)
        rejected = marked.where(~F.col(alive)).select(*[field(c) for c in records.columns])
        return Filtered(kept, rejected if self.rejects else None)


def by_predicate(predicate: Column) -> Stage:
    """The stage that keeps rows for which ``predicate`` is true."""

    def mark(records: DataFrame, alive: str) -> DataFrame:
        return records.withColumn(alive, F.col(alive) & F.coalesce(predicate, F.lit(False)))

    return Stage(mark, lambda records: records.where(predicate))


def run_stages(
    records: DataFrame,
    stages: Iterable[tuple[str, Callable[[DataFrame], Filtered]]],
    cut: Callable[[DataFrame, str], DataFrame] | None = None,
    counts: dict[str, Observation] | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Run named stages in order; rejected rows are kept under the stage's name.

    ``cut`` writes a DataFrame, split by the named column, and reads it back. With it, every stage
    runs once, for kept and rejected rows alike, and ``counts`` gets an observation of the
    ``rows`` each stage leaves; stages must then be ``Stage`` objects. Without it the results are
    plans of their own.
    """
    stages = list(stages)
    rejects: dict[str, DataFrame] = {}
    if cut is None:
        for name, stage in stages:
            records, rejected = stage(records)
            if rejected is not None:
                rejects[name] = rejected
        return records, rejects
    number, alive = temp_name("stage"), temp_name("alive")
    columns_before = []
    records = records.withColumn(number, F.lit(-1))
    for i, (name, stage) in enumerate(stages):
        columns_before.append([c for c in records.columns if c != number])
        records = stage.mark(records.withColumn(alive, F.col(number) < 0), alive)
        falls = (F.col(number) < 0) & ~F.col(alive)
        records = records.withColumn(number, F.when(falls, i).otherwise(F.col(number))).drop(alive)
        if counts is not None:
            counts[name] = Observation(f"{name} {temp_name('rows')}")
            records = records.observe(counts[name], F.count_if(F.col(number) < 0).alias("rows"))
    marked = cut(records, number)
    for i, (name, stage) in enumerate(stages):
        if stage.rejects:
            rejects[name] = marked.where(F.col(number) == i).select(*[field(c) for c in columns_before[i]])
    kept = marked.where(F.col(number) == -1).select(*[field(c) for c in records.columns if c != number])
    return kept, rejects


# The stage that changes nothing.
keep_all = Stage(lambda records, alive: records, lambda records: records, rejects=False)


def trim_columns(records: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip spaces around the values of the named columns that exist."""
    return records.withColumns(
        {c: F.trim(field(c)) for c in columns if c in records.columns}
    )


def primary_records(instrument: str, instance: str) -> Stage:
    """Keep records that are no repeat: a blank instrument and no instance.

    A null instrument is not blank, so such a record is rejected.
    """
    return by_predicate((field(instrument) == "") & field(instance).isNull())


def _lower_tail(name: Column) -> Column:
    return F.concat(F.left(name, F.lit(1)), F.lower(F.substr(name, F.lit(2))))


def looks_like_test(title: Column, first: Column, last: Column) -> Column:
    """Whether a record was entered as a test. Nulls count as blank.

    True when the title is blank or a single word, or when both names are
    given and neither is well formed.
    """
    title, first, last = (F.coalesce(c, F.lit("")) for c in (title, first, last))
    bad_first = (first != "") & ~is_well_formed_first(_lower_tail(first))
    bad_last = (last != "") & ~is_well_formed_last(_lower_tail(last))
    return ~title.contains(" ") | (bad_first & bad_last)


def split_test_records(title: str, first: str, last: str) -> Stage:
    """Split off test records; both sides are returned."""
    return by_predicate(~looks_like_test(field(title), field(first), field(last)))
